"""Language of texts by character n-grams in bit-sliced Bloom filters.

Learning: runs of :data:`N` characters (letters, with single blanks between words) are counted per language over labelled texts. A
language gets those grams whose share among its own is at least :data:`SHARE` of the share in the language where they are most
common, the :data:`GRAMS` commonest at most. All languages share one Bloom filter whose slots hold a bit per language: one look-up of
a gram gives the mask of all languages that contain it.

Deciding: the masks of a text's grams are counted per language. A language whose slices are filled to ``f`` answers yes by mistake with
chance ``p = f ** HASHES``, so a count ``c`` of ``n`` is corrected to ``(c - n p) / (1 - p)``. The largest wins; ties go to the language
with more learned texts, then to the smaller name. The score is the corrected share of grams, cut to 0..1.

The classifier is learned from a bounded sample: about :data:`TEXTS` whole texts per language, chosen by a hash of the id. The
model (one filter of :data:`SLOTS` slots) is of fixed size and travels with the task; every text is judged as a whole.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and for all texts if nothing could be learned; a text with
letters of which no gram is known gets the language with most learned texts, score 0; a long text is judged whole, as a run of its own. Null languages are not learned; rows
repeat as they come; other columns pass through, existing columns of the output's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from offerloom.llm.common import release

N = 4
TEXTS = 1500
GRAMS = 20_000
LEAST = 3
SHARE = 0.2
SLOTS = 1 << 18
HASHES = 3
UNKNOWN = "und"
_RUN = 500_000
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter; built once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all grams, the text each belongs to, and whether each text has a letter."""
    gap = " " * (N // 2)
    low = [gap + t.lower() + gap for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = letters()[points]
    has = np.bincount(owner[letter], minlength=len(low)) > 0
    if len(points) < N:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), has
    size = len(points) - N + 1
    # No gram holds two characters in a row that are not letters, so none reaches from one text into the next.
    ok = np.ones(size, dtype=bool)
    for i in range(N - 1):
        ok &= letter[i : size + i] | letter[i + 1 : size + i + 1]
    at = np.flatnonzero(ok)
    plain = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    h = np.zeros(len(at), dtype=np.uint64)
    for i in range(N):
        h = (h ^ plain[at + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h, owner[at], has


def _runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of runs of bounded size."""
    run, start, size = [], 0, 0
    for i, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size >= _RUN or i == len(texts) - 1:
            yield start, run
            run, start, size = [], i + 1, 0


def _slots(h: np.ndarray) -> list[np.ndarray]:
    bits = SLOTS.bit_length() - 1
    return [((h >> np.uint64(bits * k)) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


class Filters:
    """Bit-sliced Bloom filters of all languages: each slot is one or more words of 64 languages."""

    def __init__(self, names: list[str], grams_of: dict[str, np.ndarray]):
        self.names = names
        self.masks = np.zeros((max(1, -(-len(names) // 64)), SLOTS), dtype=np.uint64)
        for i, name in enumerate(names):
            for slot in _slots(grams_of.get(name, np.zeros(0, dtype=np.uint64))):
                self.masks[i // 64][slot] |= np.uint64(1 << (i % 64))
        fill = [float(np.mean((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(names))]
        self.mistake = np.array(fill) ** HASHES

    def counts(self, h: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Corrected number of grams per text and language."""
        slots = _slots(h)
        n = np.bincount(owner, minlength=texts).astype(float)
        out = np.zeros((texts, len(self.names)))
        for word, column in enumerate(self.masks):
            mask = column[slots[0]]
            for slot in slots[1:]:
                mask &= column[slot]
            for i in range(word * 64, min(len(self.names), word * 64 + 64)):
                hit = owner[((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(bool)]
                found = np.bincount(hit, minlength=texts)
                out[:, i] = (found - n * self.mistake[i]) / max(1e-9, 1 - self.mistake[i])
        return out

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        languages, scores = [], []
        for _, run in _runs(texts):
            h, owner, has = grams(run)
            n = np.maximum(np.bincount(owner, minlength=len(run)), 1)
            if not self.names:
                languages += [UNKNOWN] * len(run)
                scores += [0.0] * len(run)
                continue
            counts = self.counts(h, owner, len(run))
            # Names are in the order of preference, and argmax takes the first of equals.
            best = np.argmax(np.where(counts > 0, counts, 0), axis=1)
            share = np.clip(counts[np.arange(len(run)), best] / n, 0.0, 1.0)
            languages += [self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has.tolist(), strict=True)]
            scores += np.where(has, share, 0.0).tolist()
        return languages, scores


def held_out(id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled(df: DataFrame, id: str, text: str, lang: str, texts: int = TEXTS) -> tuple[list[str], DataFrame]:
    """Languages, those with most texts first, and about ``texts`` whole labelled texts of each, chosen by a hash of the id."""
    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(id).alias("_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(per, key=lambda x: (-per[x], x))
    if not names:
        return names, rows.select("text", "lang")
    # The hash decides, so the sample needs no sort and no shuffle of texts.
    part = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    limit = F.element_at(F.create_map(*[x for k, v in per.items() for x in (F.lit(k), F.lit(min(1.0, texts / v)))]), F.col("lang"))
    return names, rows.filter(part < limit).select("text", "lang")


def fit(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", texts: int = TEXTS) -> Filters:
    """Learn from the rows of ``df`` with text and language, about ``texts`` per language."""
    names, sample = labelled(df, id, text, lang, texts)
    if not names:
        return Filters([], {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for start, run in _runs(batch.column(0).to_pylist()):
                h, owner, _ = grams(run)
                own = langs[start : start + len(run)]
                for name in sorted(set(own)):
                    values, n = np.unique(h[(own == name)[owner]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                    )
        release()

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("lang")
    share = F.col("n") / F.col("_all")
    chosen = (
        counted.withColumn("_all", F.sum("n").over(own))
        .withColumn("_top", F.max(share).over(Window.partitionBy("gram")))
        .filter((F.col("n") >= LEAST) & (share >= SHARE * F.col("_top")))
        .withColumn("_rank", F.row_number().over(own.orderBy(F.desc("n"), "gram")))
        .filter(F.col("_rank") <= GRAMS)
        .select("lang", "gram")
    )
    found: dict[str, list[int]] = {}
    for r in chosen.collect():  # at most GRAMS integers a language
        found.setdefault(r["lang"], []).append(r["gram"])
    return Filters(names, {k: np.array(v, dtype=np.int64).view(np.uint64) for k, v in found.items()})


def predict(df: DataFrame, model: Filters, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the language and score of the whole text; nothing but the text is read."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            languages, scores = shared.value.decide(texts.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])
        release()

    judged = df.withColumn("_judged", arrow_udf(judge, "struct<lang:string,score:double>")(F.col(text).cast("string")))
    return judged.withColumns({lang: F.col("_judged.lang"), score: F.col("_judged.score")}).drop("_judged")
