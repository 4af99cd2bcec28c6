"""Language ID by n-gram filters that answer for all languages at once.

Every language has a Bloom filter of its frequent n-grams. The filters share one table
whose cells hold one bit per language (bit-sliced), so one AND over the cells
of an n-gram gives the bitmask of all languages that may contain it. A text gets one
count per language, corrected for the filter's false positives; the largest decides.

Defined results: a null text, and one without a letter, is ``und`` with score 0. A text with letters
but no known n-gram gets the language with most training n-grams and score 0. Without any labelled row
every text is ``und``; more than ``MOST_LANGUAGES`` languages are an error. Repeated n-grams count each time. Equal counts go to the language that sorts first. Texts are taken whole.
Learning names its columns anew and prediction is a column, so other columns of the input, whatever their names, stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, texts_of

UNKNOWN = "und"
GRAM = 4
MOST_LANGUAGES = 4096


@dataclass(frozen=True)
class LanguageFilters:
    languages: tuple[str, ...]
    cells: np.ndarray  # uint64[planes, slots]; bit b of plane p stands for language 64 p + b
    false_rates: np.ndarray  # chance that a foreign n-gram passes, per language
    fallback: int
    hashes: int


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray | None:
    """Hashes of the character n-grams of the letters, runs of anything else being one space.

    None if the text has no letter.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    body = np.where(letter, points, np.uint32(32))[keep]
    padded = np.full(len(body) + 3, 32, dtype=np.uint64)
    padded[2:-1] = body
    code = padded[: len(padded) - GRAM + 1].copy()
    for i in range(1, GRAM):
        code = code * np.uint64(0x110001) + padded[i : len(padded) - GRAM + 1 + i]
    return mix(code)


def _slots(codes: np.ndarray, slots: int, hashes: int):
    step = (codes >> np.uint64(32)) | np.uint64(1)
    for i in range(hashes):
        yield ((codes + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64)


def build_filters(
    frequent: dict[str, np.ndarray], slots: int, hashes: int, totals: dict[str, int] | None = None
) -> LanguageFilters:
    """Filters from the n-gram hashes of each language; ``totals`` counts all n-grams it was learned from."""
    languages = tuple(sorted(frequent))
    planes = max(1, -(-len(languages) // 64))
    cells = np.zeros((planes, slots), dtype=np.uint64)
    rates = np.zeros(len(languages))
    for k, language in enumerate(languages):
        plane, bit = cells[k // 64], np.uint64(1) << np.uint64(k % 64)
        for places in _slots(frequent[language], slots, hashes):
            plane[np.unique(places)] |= bit
        rates[k] = (np.count_nonzero(plane & bit) / slots) ** hashes
    sizes = [totals[name] if totals else len(frequent[name]) for name in languages]
    return LanguageFilters(languages, cells, rates, int(np.argmax(sizes)) if sizes else 0, hashes)


def classify(text: str | None, model: LanguageFilters) -> tuple[str, float]:
    codes = grams(text) if text else None
    if codes is None or not model.languages:
        return UNKNOWN, 0.0
    found = np.full((len(model.cells), len(codes)), ~np.uint64(0))
    for places in _slots(codes, model.cells.shape[1], model.hashes):
        found &= model.cells[:, places]
    hits = np.array([
        np.count_nonzero(found[k // 64] & (np.uint64(1) << np.uint64(k % 64)))
        for k in range(len(model.languages))
    ])
    real = (hits - len(codes) * model.false_rates) / (1 - model.false_rates)
    best = int(np.argmax(real))
    if real[best] <= 0:
        return model.languages[model.fallback], 0.0
    return model.languages[best], float(min(1.0, real[best] / len(codes)))


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    sample_per_language: int = 2000,
    grams_per_language: int = 6000,
    slots: int = 1 << 18,
    hashes: int = 3,
) -> LanguageFilters:
    """Learn the filters from rows with a language.

    ``sample_per_language`` bounds what is learned from: where a language has more rows, those with
    the smallest hash of ``key`` are used, about that many. The n-grams of a language are its most
    frequent ones. The driver receives languages x grams_per_language codes at most.
    """
    rows = labelled.select(
        F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    ).where("_lang is not null and _text is not null")
    sizes = {r["_lang"]: r["_n"] for r in rows.groupBy("_lang").agg(F.count("*").alias("_n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return build_filters({}, slots, hashes)
    # the shares are constants, so no text moves to be chosen
    shares = F.create_map(*[F.lit(x) for name, n in sorted(sizes.items()) for x in (name, sample_per_language / n)])
    sample = rows.where(F.xxhash64("_key", "_text") / F.lit(2.0**64) + 0.5 < shares[F.col("_lang")])

    def count(batches):
        for batch in batches:
            langs = batch.column("_lang").to_pylist()
            texts = texts_of(batch.column("_text"))
            for name in sorted(set(langs)):
                parts = [grams(t) for t, at in zip(texts, langs, strict=True) if at == name]
                parts = [p for p in parts if p is not None]
                if parts:
                    codes, times = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([name] * len(codes)),
                        "code": pa.array(codes.view(np.int64)),
                        "times": pa.array(times.astype(np.int64)),
                    })

    counted = sample.mapInArrow(count, "lang string, code long, times long")
    totals = counted.groupBy("lang", "code").agg(F.sum("times").alias("times"))
    ranked = totals.selectExpr(
        "*", "row_number() over (partition by lang order by times desc, code) as place",
        "sum(times) over (partition by lang) as total",
    ).where(F.col("place") <= grams_per_language)
    found: dict[str, list[int]] = {}
    sums: dict[str, int] = {}
    for row in ranked.select("lang", "code", "total").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["code"])
        sums[row["lang"]] = row["total"]
    frequent = {k: np.sort(np.array(v, dtype=np.int64)).view(np.uint64) for k, v in found.items()}
    return build_filters(frequent, slots, hashes, sums)


def predict(text: Column, model: LanguageFilters) -> Column:
    """Struct of the predicted language and its score, the share of n-grams that speak for it."""

    @F.arrow_udf("lang_pred string, score double")
    def run(values: pa.Array) -> pa.Array:
        done = [classify(value, model) for value in values.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.float64())],
            names=["lang_pred", "score"],
        )

    return run(text)


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
