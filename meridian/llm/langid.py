"""Language identification by compression.

Every language has a zstandard raw-content dictionary of its own text. A text is encoded with each dictionary, and the
language whose encoding is smallest is the answer; where the runner-up comes close, the answer is rejected.

Trained on a bounded sample of whole texts: in the order of their keys' hashes a language's documents are taken up to
DOCS of them and up to the one with which they pass DICTIONARY bytes; those of over LONGEST bytes come last. Applied to
whole texts in chunks of CHUNK bytes, each encoded on its own.

Null texts and texts without a letter are ``und`` with score 0. Ties go to the language that sorts first. Without
training rows every text is ``und``. Of rows that repeat a key each counts. ``keep`` may not name a column made here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import broadcast_bytes, pack, prepare, unpack

DOCS, DICTIONARY, LONGEST = 400, 500_000, 16_000
CHUNK, LEVEL = 512, 9
#: Least share by which the second encoding must be larger.
MARGIN = 0.01
MOST_LANGUAGES = 500


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """A dictionary for each language: the documents whose keys hash lowest."""
    rows = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 2.0 * DOCS / n))])
    mark = F.xxhash64(F.col("key").cast("string"), F.lit("sample"))
    some = rows.withColumn("h", mark).filter(F.pmod("h", F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    # the hash has thinned the rows to about 2 * DOCS a language; rows that repeat one key in masses are thinned by the limit
    some = some.select("lang", (F.octet_length("text") > LONGEST).alias("long"), "h", F.xxhash64("text").alias("t"), F.octet_length("text").alias("n"), "text")
    some = some.orderBy("long", "h", "lang", "t", "text").limit(4 * DOCS * len(counts))
    order = Window.partitionBy("lang").orderBy("long", "h", "t", "text")
    some = some.withColumns({"nth": F.row_number().over(order), "before": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    found: dict[str, list[str]] = {}
    for r in some.filter((F.col("nth") <= DOCS) & (F.col("before") < DICTIONARY)).orderBy("lang", "nth").select("lang", "text").collect():
        found.setdefault(r.lang, []).append(r.text.lower())
    return {k: "\n".join(v).encode() for k, v in found.items()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], margin: float = MARGIN):
        self.names, self.margin = sorted(dictionaries), margin
        self.compressors = []
        for name in self.names:
            raw = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=raw, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        parts = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.compressors]

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, rejected."""
        if not text or not self.names or not regex.search(r"\p{L}", text):
            return "und", 0.0, 0.0, True
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        if len(order) == 1:
            return self.names[0], 1.0, 1.0, False
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / second
        return self.names[order[0]], 1 / (1 + math.exp(-min(60, second - best) / 4)), margin, margin < self.margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred, score (0.5 to 1: how clearly it beats the next), margin and rejected."""
    spark = prepare(docs.sparkSession)
    if {"lang_pred", "score", "margin", "rejected", "text"} & {c.lower() for c in keep}:
        raise ValueError("keep names a column that is made here")
    model = broadcast_bytes(spark, pack(dictionaries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(unpack(model.value)[0], margin)
        for batch in batches:
            found = [classify(t) for t in batch.column(len(keep)).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.float64(), pa.float64(), pa.bool_()))] if found else [pa.array([], t) for t in (pa.string(), pa.float64(), pa.float64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=[*keep, "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *fields]))
