"""Budgets on the tree by hand, prefixes by sorting."""

import hashlib
from collections import defaultdict

from conftest_llm import plain_words
from parcelsight.llm import mixing


def plain_share(children, budget):
    """children: name -> (weight, room). Whole tokens for each, shortages going to the others."""
    order = sorted(children, key=lambda c: (children[c][1] / children[c][0], c))
    given, open_names = {}, list(order)
    for name in order:
        weight, room = children[name]
        left = budget - sum(given.values())
        if left * weight >= room * sum(children[c][0] for c in open_names):
            given[name] = room
            open_names.remove(name)
        else:
            break
    left = budget - sum(given.values())
    total = sum(children[c][0] for c in open_names)
    return given | {c: left * children[c][0] // total for c in open_names}


def plain(rows, targets):
    """(doc_id, copies) of rows (doc_id, text, lang, source)."""
    leaves = defaultdict(list)
    names = ("web", "books", "code", "forum")
    for doc_id, text, lang, source in rows:
        digits = (source or "")[len((source or "").rstrip("0123456789")) :]
        domain = names[int(digits) % 4] if digits else "other"
        leaves[domain, lang or "", source or ""].append((doc_id, len(plain_words(text))))
    tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
    budget = {(): sum(tokens.values()) * targets.hundredths // 100}
    for depth, level in enumerate(mixing.LEVELS):
        families = defaultdict(lambda: defaultdict(int))
        for leaf, n in tokens.items():
            families[leaf[:depth]][leaf[: depth + 1]] += n * targets.epochs
        for above, children in families.items():
            weighted = {c: (getattr(targets, level).get(c[-1], 1), room) for c, room in children.items()}
            budget |= plain_share(weighted, budget[above])
    out = []
    for leaf, docs in leaves.items():
        whole = budget[leaf] // tokens[leaf] if tokens[leaf] else 0
        left = budget[leaf] - whole * tokens[leaf]
        by_key = defaultdict(list)
        for doc_id, n in docs:
            name = "" if doc_id is None else doc_id
            by_key[hashlib.md5(f"{targets.seed}:{whole}:{name}".encode()).hexdigest()].append((doc_id, n))
        used, fits = 0, bool(tokens[leaf])
        for key in sorted(by_key):
            used += sum(n for _, n in by_key[key])
            fits = fits and used <= left
            out += [(doc_id, whole + fits) for doc_id, _ in by_key[key]]
    return sorted(out, key=str)


ODD = [(900, None, "en", "src1"), (901, "", None, None), (902, "only one", "xx", "weird"), (903, " \n", "en", ""), (904, "a b c", "en", "src2"), (904, "a b c", "en", "src2")]


def copies(df):
    return sorted(((r.doc_id, r.copies) for r in df.collect()), key=str)


def test_copies_equal_those_found_by_sorting(documents, table):
    for targets in (mixing.Targets(), mixing.Targets(hundredths=250, epochs=3, seed=5), mixing.Targets(hundredths=0)):
        rows = [*documents, *ODD]
        assert copies(mixing.chosen(table(rows), targets)) == plain(rows, targets)


def test_budgets_hold_and_shortages_go_to_siblings_first(spark):
    leaves = [("web", "en", "a", 100), ("web", "en", "b", 1_000), ("web", "de", "c", 10), ("code", "en", "d", 1_000)]
    table = spark.createDataFrame(leaves, "domain string, language string, source string, tokens long")
    even = mixing.Targets(domain={}, language={}, source={}, hundredths=50, epochs=1)
    got = {r.source: r.budget for r in mixing.budgets(table, even).collect()}
    # 1,055 tokens: half for each domain. German has 10 of its 263, so English gets 517 of web's 527;
    # source a has 100 of 258, so b gets 417. Code is not touched.
    assert got == {"a": 100, "b": 417, "c": 10, "d": 527}
    short = [("web", "en", "a", 100), ("code", "en", "d", 1_000), ("code", "de", "e", 50)]
    table = spark.createDataFrame(short, "domain string, language string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.budgets(table, even).collect()}
    assert got == {"a": 100, "d": 425, "e": 50}


def test_mixed_rows_are_there_as_often_as_taken(documents, table):
    targets = mixing.Targets(hundredths=100, epochs=3)
    rows = [*documents, *ODD]
    made = mixing.mixed(table(rows), targets)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = sorted((str(d) for d, n in plain(rows, targets) for _ in range(n)))
    assert sorted(str(r.doc_id) for r in made.collect()) == want


def test_an_empty_table(table):
    assert mixing.chosen(table([])).collect() == []
    assert mixing.mixed(table([])).collect() == []


def test_clashing_columns_stay(table):
    names = ["_row", "_id", "_n", "_own", "domain", "copies", "node"]
    docs = table([(1, "one text of words here", "en", "src1"), (2, "other words in this text", "de", "src2")])
    for i, name in enumerate(names):
        docs = docs.selectExpr("*", f"{i} as `{name}`")
    made = mixing.mixed(docs, mixing.Targets(hundredths=100, epochs=1))
    assert made.count() == 2
    assert made.columns == docs.columns
    assert all([r[n] for n in names] == list(range(7)) for r in made.collect())
