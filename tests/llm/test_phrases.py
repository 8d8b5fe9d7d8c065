"""Phrase fingerprints: parsing letter by letter, neighbours by sorting."""

import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from parcelsight.llm import phrases


def alike(left, right):
    return phrases.likeness(bytes.fromhex(left), bytes.fromhex(right))


def plain_parse(text):
    known, ends, piece = set(), [], ""
    for i, sign in enumerate(text):
        piece += sign
        if piece not in known:
            known.add(piece)
            ends.append(i + 1)
            piece = ""
    return ends + [len(text)] * bool(piece)


@given(st.text("ab", max_size=60) | st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_phrases_are_those_found_letter_by_letter(text):
    assert phrases.parse(text, set()) == plain_parse(text)


@given(st.text("abc", max_size=60), st.text("abc", max_size=30))
def test_an_edited_text_is_printed_as_on_its_own(text, following):
    changed, print_of = phrases.Printed(text).edited(following)
    assert changed == phrases.edited(text, following)
    assert print_of.hex() == phrases.fingerprint(changed)


def test_likeness_estimates_that_of_the_phrase_sets(documents):
    def pieces(text):
        ends = plain_parse(text)
        return {text[i:j] for i, j in zip([0, *ends], ends)}

    off = []
    texts = [t for _, t, _, _ in documents if 400 < len(t) < 3_000][:40]
    for one, two in zip(texts, texts[1:]):
        two = phrases.edited(one, two)
        a, b = pieces(one), pieces(two)
        off.append(alike(phrases.fingerprint(one), phrases.fingerprint(two)) - len(a & b) / len(a | b))
    assert abs(np.mean(off)) < 0.03 and np.abs(off).max() < 0.25


def test_empty_texts():
    assert phrases.fingerprint("") == ""
    assert alike("", "") == 1 and alike("", phrases.fingerprint("x")) == 0


def plain_rows(rows):
    """Rows by descending id with the next one; the id decides, so ids are distinct here."""
    rows = sorted(((d, t or "") for d, t in rows), reverse=True)
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        own, other, after = (phrases.fingerprint(x) for x in (text, changed, following))
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other, alike(own, other), alike(own, after))
        )
    return sorted(out)


def columns(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect())


def test_every_document_meets_the_next_one(documents, table):
    rows = [(d, t) for d, t, _, _ in documents] + [(-5, None), (9_001, ""), (9_002, "é日" * 50)]
    assert columns(phrases.with_next(table(rows))) == plain_rows(rows)


def test_few_rows(table):
    for rows in ([], [(1, "alone it is")], [(1, "a b c"), (2, "d e f")]):
        assert columns(phrases.with_next(table(rows))) == plain_rows(rows)


def test_repeated_ids_and_no_id(table):
    rows = [(4, "one text"), (4, "one text"), (4, "another"), (None, "without"), (9, "last")]
    got = phrases.with_next(table(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((r[0] or 0, len(r[1])) for r in rows)
    assert len({r.fingerprint for r in got if r.n_chars == 8 and r.doc_id == 4}) == 1
    (last,) = [r for r in got if r.doc_id is None]
    assert last.near_next == alike(phrases.fingerprint("without"), phrases.fingerprint("last"))


@pytest.mark.parametrize("size", [10_000])
def test_a_long_text(table, size):
    rows = [(1, "abcde " * size), (2, "x" * size)]
    assert columns(phrases.with_next(table(rows))) == plain_rows(rows)
