"""Language identification by compression.

For each language a dictionary of raw text is built from labelled documents. A text is cut
into blocks, each block is compressed once with each dictionary, and the language whose
dictionary makes the sum of the blocks smallest is chosen. A text whose best and second best
sizes lie too close together is rejected.

Training reads a bounded sample: of each language `SLICES` documents, chosen by a hash of
their id, and of each one passage of at most `SLICE_CHARS` characters. A language needs no
more, and the dictionaries (at most `SLICES * SLICE_CHARS` characters each) are small enough
to travel with the tasks. Identification reads every text whole.

Defined results: a null text, or one without a letter, is `und` with score 0 and is rejected;
without any labelled row all texts are `und`; rows with a null label teach nothing; repeated
rows get a row each; ties go to the language that is first in code-point order; an empty
table gives an empty table; other columns are not read.
"""

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.llm.common import only, slices

SLICES = 256
SLICE_CHARS = 512
BLOCK_BYTES = 2048
LEVEL = 6
MAX_LANGUAGES = 400
MIN_MARGIN = 0.004  # of the best size; below it the text is rejected
UNKNOWN = "und"

_letter = regex.compile(r"\p{L}")


def train(labelled: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A raw-content dictionary per language, from the rows where `use` holds."""
    rows = labelled.filter(use & F.col(f"`{lang_col}`").isNotNull())
    rows = only(rows, id=id_col, text=text_col, lang=lang_col).filter(F.col("text").rlike(r"\p{L}"))
    hashed = rows.withColumn("h", F.xxhash64(F.lit("language"), "id")).withColumn("slot", F.pmod("h", F.lit(SLICES)))
    first = hashed.select("lang", "slot", "h").groupBy("lang", "slot").agg(F.min("h").alias("h"))
    chosen = first.limit(MAX_LANGUAGES * SLICES + 1).collect()
    if len({r.lang for r in chosen}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not chosen:
        return {}
    spark = labelled.sparkSession
    bounded = F.broadcast(spark.createDataFrame([(r.lang, r.h) for r in chosen], "lang string, h long"))
    start = F.floor(F.greatest(F.length("text") - SLICE_CHARS, F.lit(0)) * (F.pmod("h", F.lit(997)) / F.lit(997.0))).cast("int") + 1
    passages = hashed.join(bounded, ["lang", "h"]).select("lang", "h", F.substring("text", start, F.lit(SLICE_CHARS)).alias("passage"))
    one_each = passages.groupBy("lang", "h").agg(F.min("passage").alias("passage")).orderBy("lang", "h").collect()
    texts: dict[str, list[str]] = {}
    for r in one_each:
        texts.setdefault(r.lang, []).append(r.passage)
    longest = max(len("\n".join(t).encode()) for t in texts.values())
    # Equal amounts of text: a language with little of it repeats what it has.
    out = {}
    for lang, parts in texts.items():
        own = "\n".join(parts).encode()
        out[lang] = (own + b"\n") * max(1, min(longest // len(own), 64))
    return out


@lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in model:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False)))
    return out


def compressed_sizes(text: bytes, model: tuple[tuple[str, bytes], ...]) -> list[int]:
    """Bytes of the text under each language's dictionary."""
    blocks = [text[i : i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
    return [sum(len(c.compress(b)) for b in blocks) for _, c in _compressors(model)]


def decide(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float, float]:
    """(language, score, margin). The score is 1/2 at a tie and nears 1 with the margin."""
    if not model or text is None or not _letter.search(text):
        return UNKNOWN, 0.0, 0.0
    sizes = sorted(zip(compressed_sizes(text.lower().encode(), model), (lang for lang, _ in model)))
    best, lang = sizes[0]
    margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
    return lang, 1.0 - 0.5 / (1.0 + 50.0 * margin), margin


def identify(
    docs: DataFrame,
    model: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """doc_id, lang_pred, score, margin and accepted for every row of `docs`."""
    known = tuple(sorted((lang, content.decode().lower().encode()) for lang, content in model.items()))
    docs = only(docs, doc_id=id_col, text=text_col)
    kind = dict(docs.dtypes)["doc_id"]

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 1 << 23):
            found = [decide(t, known) for t in batch.column(1).to_pylist()]
            lang, score, margin = zip(*found) if found else ((), (), ())
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "lang_pred": pa.array(lang, pa.string()),
                    "score": pa.array(score, pa.float64()),
                    "margin": pa.array(margin, pa.float64()),
                    "accepted": pa.array([l != UNKNOWN and m >= min_margin for l, m in zip(lang, margin)], pa.bool_()),
                }
            )

    return docs.mapInArrow(identified, f"doc_id {kind}, lang_pred string, score double, margin double, accepted boolean")


def identified_rows(docs: DataFrame, model: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of `docs`, all their columns, whose language is identified."""
    known = tuple(sorted((lang, content.decode().lower().encode()) for lang, content in model.items()))
    place = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place, 1 << 23):
            found = [decide(t, known) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and margin >= min_margin for lang, _, margin in found], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
