"""Language of whole texts by mixture inference over character n-grams.

Learning counts the hashed trigrams of each language over all labelled texts: a table of
2**15 likelihoods for each language.  A text is taken as a mixture: each of its trigrams
comes from one language, with a probability that is the language's share of the text.
Expectation-maximisation estimates the shares.  Which languages take part is decided by
penalised likelihood: the languages with the largest shares enter one after the other
while the gain in log likelihood exceeds half the logarithm of the number of trigrams,
with overlapping trigrams counted as one observation in three.

Trigrams run over the lower-case letters of the text, every stretch of other characters
being one blank.  Defined results: a null text, one without a letter and every text under
an empty model are ``und`` with score 0; ties go to the language that sorts first; equal
texts get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgepole.llm import hashes

BUCKETS = 1 << 15
#: Characters of texts that a task works on at a time.
CHARS = 1 << 18
UNKNOWN = "und"
SMOOTHING = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """Buckets of a text's trigrams, in order; empty if it has no letter."""
    chars = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    first = int(letter.argmax())
    keep[max(first - 1, 0)] = True
    chars = np.where(letter, chars, np.uint32(32))[keep]
    mixed = chars[:-2] * np.uint32(0x9E3779B1) + chars[1:-1] * np.uint32(0x85EBCA77) + chars[2:] * np.uint32(0xC2B2AE3D)
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    likelihood: np.ndarray  # (languages, BUCKETS)


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Likelihoods from every labelled text.  What reaches the driver is bounded by the number of languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if len(grams := trigrams(value.as_py())):
                    own = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                    own += np.bincount(grams, minlength=BUCKETS)
        for name, own in totals.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used)), pa.array(used), pa.array(own[used])], names=["lang", "bucket", "n"])

    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    counts = labelled.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((len(languages), BUCKETS))
    for i, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        table[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    table += SMOOTHING
    return Model(languages, (table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _mixture(likely: np.ndarray, counts: np.ndarray, offsets: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages for each text and their log likelihoods."""
    sizes = np.diff(np.append(offsets, len(counts)))
    total = np.add.reduceat(counts, offsets)
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for turn in range(rounds + 1):
        parts = np.repeat(shares, sizes, axis=0) * likely
        whole = parts.sum(axis=1)
        if turn == rounds:
            break
        shares = np.add.reduceat(parts * (counts / whole)[:, None], offsets, axis=0) / total[:, None]
    return shares, np.add.reduceat(counts * np.log(whole), offsets)


def infer(model: Model, texts: list[str | None], rounds: int = 12) -> tuple[list[str], np.ndarray, list[str]]:
    """Main language, its share, and all languages of each text with their shares."""
    names, scores, sets = [UNKNOWN] * len(texts), np.zeros(len(texts)), [""] * len(texts)
    used, times, owners = [], [], []
    for i, text in enumerate(texts):
        if text and model.languages and len(g := trigrams(text)):
            found = np.bincount(g, minlength=BUCKETS)
            used.append(np.flatnonzero(found))
            times.append(found[used[-1]])
            owners.append(i)
    if not owners:
        return names, scores, sets
    sizes = np.array([len(u) for u in used])
    offsets = np.cumsum(sizes) - sizes
    counts = np.concatenate(times).astype(np.float64)
    likely = model.likelihood[:, np.concatenate(used)].T.astype(np.float64)
    total = np.add.reduceat(counts, offsets)
    n, k = len(owners), len(model.languages)

    shares, _ = _mixture(likely, counts, offsets, np.ones((n, k)), rounds)
    order = np.argsort(-shares, axis=1, kind="stable")
    single = np.add.reduceat(counts[:, None] * np.log(likely), offsets, axis=0)
    best = np.zeros((n, k))
    main = single.argmax(axis=1)
    best[np.arange(n), main] = 1.0
    # the language that explains the text best alone comes first
    order = np.array([[m, *[x for x in row if x != m]] for m, row in zip(main, order)])
    reached, live = single.max(axis=1), np.arange(n)
    for many in range(2, k + 1):
        allowed = np.zeros((len(live), k))
        np.put_along_axis(allowed, order[live, :many], 1.0, axis=1)
        at = hashes.expand(offsets[live], sizes[live])
        own = np.cumsum(sizes[live]) - sizes[live]
        found, value = _mixture(likely[at], counts[at], own, allowed, rounds)
        better = (value - reached[live]) / 3 > 0.5 * np.log(total[live])
        live, found, value = live[better], found[better], value[better]
        if not len(live):
            break
        best[live], reached[live] = found, value
    for j, i in enumerate(owners):
        top = int(best[j].argmax())
        names[i], scores[i] = model.languages[top], min(1.0, float(best[j, top]))
        sets[i] = ",".join(f"{model.languages[x]}:{best[j, x]:.3f}" for x in np.argsort(-best[j], kind="stable") if best[j, x] > 0)
    return names, scores, sets


def predict(docs: DataFrame, model: Model, text: Column) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``lang_mix`` (``en:0.700,fr:0.300``); they replace columns of these names."""
    added = ["lang_pred", "score", "lang_mix"]
    keep = [c for c in docs.columns if c not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in hashes.slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), CHARS):
                names, scores, sets = infer(model, texts.slice(a, b - a).to_pylist())
                rest = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rest.columns[:-1], pa.array(names), pa.array(scores), pa.array(sets)], names=[*keep, *added])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]], "lang_pred string, score double, lang_mix string"])
    return rows.mapInArrow(run, schema)
