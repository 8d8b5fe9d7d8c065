"""The manifest against a plain tree, folded by hashing every run anew."""

import hashlib
import random
import zlib

from parcelsight.llm import manifest as m


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def siblings(tree, at):
    found = []
    for below in tree[:-1]:
        first = at - at % 8
        found.append((below[first:at], below[at + 1 : first + 8]))
        at //= 8
    return found


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    key = lambda x: (x is not None, b"" if x is None else str(x).encode())
    names = sorted(groups, key=key)
    trees = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = (own, levels([leaf(r) for r in own]))
    crown = levels([trees[n][1][-1][0] for n in names])
    root, out = crown[-1][0] if names else None, []
    for place, name in enumerate(names):
        own, tree = trees[name]
        for at, row in enumerate(own):
            way = siblings(tree, at) + siblings(crown, place)
            changed = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 3 == 0
            folded = leaf((row[0], lowered(row[1]) if changed else row[1], *row[2:]))
            for left, right in way:
                folded = H(*left, folded, *right)
            proof = H(*[d for left, right in way for d in left + right])
            out.append((row[0], leaf(row), tree[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def table(spark, rows):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, position long, digest string, path string"
    return spark.createDataFrame([(*r, 5, "x", None) for r in rows], kinds).repartition(3)


def check(spark, rows, **options):
    found = m.manifest(table(spark, rows), m.tampered(), **options).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows)


def rows_of(n, langs, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["Aa bc", "x y z", "", "É ß 中"]) + str(i), rng.choice(langs), "s", i) for i in range(n)]


def test_groups_of_any_size(spark):
    rows = [(i * 1_000 + j, f"Text {j}", f"l{n}", "s", j) for i, n in enumerate((1, 2, 8, 9, 64, 65, 513)) for j in range(n)]
    check(spark, rows)
    check(spark, rows_of(1, ["en"]))


def test_many_rounds_and_groups(spark):
    rows = rows_of(700, ["en"] * 8 + [None, "", "de", "a b", "é", "z"])
    check(spark, rows, most=2)


def test_more_groups_than_a_run_holds(spark):
    check(spark, rows_of(120, [f"l{i}" for i in range(70)] + [None]), most=1)


def test_nulls_empty_and_long_texts_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, "A", "en", "s", 1),
        (3, "", "en", None, 0), (3, "", "en", None, 0), (3, "b", "en", "s", 1), (-4, "B" * 300_000, "en", "s", 300_000),
        (5, None, "en", "s", None), (6, "-", None, "-", 1), (7, None, None, None, 1),
    ]
    check(spark, rows * 3, most=1)


def test_many_equal_rows(spark):
    check(spark, [(1, "Same", "en", "s", 4)] * 200 + rows_of(40, ["en", "de"]), most=1)


def test_an_empty_table_and_no_change(spark):
    assert m.manifest(table(spark, []), m.tampered()).collect() == []
    found = m.manifest(table(spark, rows_of(30, ["en", "de"]))).collect()
    assert len(found) == 30 and all(r.verified for r in found)


def test_a_parent_goes_on_from_the_state_of_its_slot():
    digests = [H(str(i)).encode() for i in range(20)]
    tree = m.Tree(digests, 2)
    assert [len(s) for s in tree.states] == [20, 3]
    for at in range(20):
        other = H("new").encode()
        changed = [*digests[:at], other, *digests[at + 1 :]]
        assert tree.folded(at, other) == m.Tree(changed, 2).top
        assert tree.states[0][at].hexdigest() == H(*[d.decode() for d in digests[at - at % 8 : at]])


def test_other_ids_give_another_root(spark):
    rows = rows_of(20, ["en"])
    first = m.manifest(table(spark, rows)).first().root
    assert m.manifest(table(spark, [(r[0] + 1, *r[1:]) for r in rows])).first().root != first
