"""Language ID: a bidirectional gated recurrent network over bytes.

Every byte position gets label probabilities from the states of a forward and a backward
layer; a document's probabilities are their mean over its letter bytes. A text is cut into
windows of WINDOW bytes, which the layers run over side by side; all windows of the whole
text count.

The network is trained in numpy by backpropagation through time on a bounded sample of
labelled rows: of every language PER_LANGUAGE documents at most (fewer where DOCUMENTS
would not do for all languages), chosen by a hash of id and text, with SLICES slices each.
Null and repeated ids are no special case: equal rows count as one document. Predicting
needs no shuffle.

Null text, empty text and text without a letter are `und` with score 0. Where nothing can
be learned (no labelled rows), every document is. Null languages are not learned from.
Repeated rows get equal answers; other columns are ignored. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from parcelsight.llm import gru
from parcelsight.llm.common import crc_of_id, released, sliced, stored, text_of

UNKNOWN = "und"
#: Documents learned from per language, and in all; slices of each. With more languages than
#: DOCUMENTS / PER_LANGUAGE each has fewer documents, but none is left out.
PER_LANGUAGE, DOCUMENTS, SLICES = 400, 80_000, 4
WINDOW, HIDDEN, BATCH, UPDATES, RATE = 128, 8, 256, 150, 0.02
#: Windows that run side by side.
WIDE = 2_048
#: Bytes that stand in letters: ASCII letters and all bytes of longer characters.
_OF_LETTERS = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    forward: dict[str, np.ndarray]
    backward: dict[str, np.ndarray]
    out: dict[str, np.ndarray]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """steps x languages x windows. windows: steps x windows of bytes."""
        start = np.zeros((HIDDEN, windows.shape[1]), np.float32)
        logits = self.out["forward"] @ gru.states(self.forward, windows, start)
        logits += (self.out["backward"] @ gru.states(self.backward, windows[::-1], start))[::-1]
        logits += self.out["bias"]
        return _softmax(logits)

    def documents(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        raw = [(x or "").encode() for x in texts]
        owners = np.repeat(np.arange(len(raw)), [-(-len(x) // WINDOW) for x in raw])
        cut = np.frombuffer(b"".join(x.ljust(-(-len(x) // WINDOW) * WINDOW, b"\0") for x in raw), np.uint8)
        cut = cut.reshape(-1, WINDOW)
        sums = np.zeros((len(raw), len(self.languages)))
        for at in range(0, len(cut), WIDE):
            windows = np.ascontiguousarray(cut[at : at + WIDE].T)
            found = self.probabilities(windows)
            found *= _OF_LETTERS[windows][:, None, :]
            np.add.at(sums, owners[at : at + WIDE], found.sum(0).T)
        total = sums.sum(1)
        names, scores = [], []
        for text, row, n in zip(texts, sums, total):
            known = n > 0 and has_letter(text)
            best = int(row.argmax()) if known else -1
            names.append(self.languages[best] if known else UNKNOWN)
            scores.append(min(1.0, float(row[best] / n)) if known else 0.0)
        return names, scores


def _softmax(logits: np.ndarray) -> np.ndarray:
    """In place, over the second last axis."""
    logits -= logits.max(-2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-2, keepdims=True)
    return logits


def fit(slices: list[tuple[str, bytes]], seed: int = 1) -> Model | None:
    """Train on (language, slice of at most WINDOW bytes); None without any."""
    if not slices:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({language for language, _ in slices})
    labels = np.array([languages.index(language) for language, _ in slices])
    windows = np.frombuffer(b"".join(x[:WINDOW].ljust(WINDOW, b"\0") for _, x in slices), np.uint8)
    windows = windows.reshape(-1, WINDOW).T
    model = Model(
        languages,
        gru.new_layer(rng, 256, HIDDEN),
        gru.new_layer(rng, 256, HIDDEN),
        {
            "forward": rng.normal(0, 0.3, (len(languages), HIDDEN)).astype(np.float32),
            "backward": rng.normal(0, 0.3, (len(languages), HIDDEN)).astype(np.float32),
            "bias": np.zeros((len(languages), 1), np.float32),
        },
    )
    parts = {"forward": model.forward, "backward": model.backward, "out": model.out}
    tuned = gru.Adam({f"{p}.{k}": w for p, weights in parts.items() for k, w in weights.items()}, RATE)
    order = np.concatenate([rng.permutation(len(labels)) for _ in range(-(-UPDATES * BATCH // len(labels)))])
    for n in range(UPDATES):
        chosen = order[n * BATCH : (n + 1) * BATCH]
        tuned.step(_gradients(model, windows[:, chosen], labels[chosen]), 1 - 0.9 * n / UPDATES)
    return model


def _gradients(model: Model, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    start = np.zeros((HIDDEN, windows.shape[1]), np.float32)
    ahead, tape = gru.states_and_tape(model.forward, windows, start)
    behind, tape_back = gru.states_and_tape(model.backward, windows[::-1], start)
    logits = model.out["forward"] @ ahead + (model.out["backward"] @ behind)[::-1] + model.out["bias"]
    wrong = _softmax(logits)
    wrong[:, labels, np.arange(len(labels))] -= 1
    counted = _OF_LETTERS[windows][:, None, :]
    wrong *= counted / max(1, counted.sum())
    grads = {
        "out.forward": np.einsum("tcb,thb->ch", wrong, ahead, optimize=True),
        "out.backward": np.einsum("tcb,thb->ch", wrong[::-1], behind, optimize=True),
        "out.bias": wrong.sum((0, 2))[:, None],
    }
    of_ahead = model.out["forward"].T @ wrong
    of_behind = (model.out["backward"].T @ wrong)[::-1]
    for name, layer, seen, steps, given in (
        ("forward", model.forward, tape, windows, of_ahead),
        ("backward", model.backward, tape_back, windows[::-1], of_behind),
    ):
        grads |= {f"{name}.{k}": g for k, g in gru.gradients(layer, steps, seen, given).items()}
    return {k: g.astype(np.float32) for k, g in grads.items()}


def held_out() -> Column:
    return crc_of_id() % 3 == 1


def sample(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Slices of a bounded number of labelled documents that are not held out: of each language
    the distinct ones (id and text) with the least hashes, however often ids repeat or are null."""
    rows = docs.where(~held_out()).where("lang is not null").where(F.length(text_of()) > 0)
    whole = 1 << 53
    place = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id", "text"), F.lit(whole)).alias("place")
    places = rows.select("lang", place).distinct()
    sizes = stored(places.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    most = max(1, min(PER_LANGUAGE, DOCUMENTS // max(1, sizes.count())))
    # Hashes lie evenly, so the least ones are all below this share of their range; it leaves
    # a language a few times what is taken, however many documents it has.
    below = (F.lit(4.0 * most + 20) / F.col("n")) * whole
    least = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    chosen = places.join(sizes, "lang").where(F.col("place") < below).withColumn("n", least).where(F.col("n") <= most).select("lang", "place")
    text, steps = F.col("text"), [i / SLICES for i in range(SLICES)]
    cuts = [F.substring(text, (F.length(text) * s).cast("int") + 1, F.lit(WINDOW)) for s in steps]
    held = rows.select("lang", place, F.array_distinct(F.array(*cuts)).alias("cuts")).join(chosen, ["lang", "place"], "left_semi")
    held = held.groupBy("lang", "place").agg(F.first("cuts").alias("cuts"))
    found = sorted((r["lang"], cut) for r in held.collect() for cut in r["cuts"])
    return [(lang, cut.encode()) for lang, cut in found if has_letter(cut)]


def train(docs: DataFrame) -> Model | None:
    return fit(sample(docs))


def predict(docs: DataFrame, model: Model | None, language: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of docs with the predicted language and its score."""
    clash = {language.lower(), score.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; name others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            names, scores = model.documents(texts) if model else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, language, score],
            )

    added = [T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(lambda batches: released(run(batches)), T.StructType([*docs.schema.fields, *added]))


#: Documents under this score belong to no learned language clearly enough.
LEAST = 0.35


def keep_known(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs whose text is clearly in a learned language."""
    names = {n.lower() for n in docs.columns}
    own = [f"_{x}" for x in ("language", "score")]
    while names & set(own):
        own = [f"_{x}" for x in own]
    found = predict(docs, train(docs), *own)
    return found.where((F.col(own[0]) != UNKNOWN) & (F.col(own[1]) >= least)).drop(*own)
