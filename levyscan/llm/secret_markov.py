"""Secret scans: base rules, and character Markov models for what the rules do not name.

Base rules find assignments of passwords and tokens, access keys and long hexadecimal runs.
Beside them, every long run of base-64 signs is scored by two character Markov models, one of
random strings and one of ordinary identifiers and words: the log-likelihood ratio per sign
decides, for the run as a whole and, where that is ordinary, for each stretch of it that is
long enough; what such a stretch touches between two of / = _ - is a span. Both are trained from labelled samples: the values that the base rules name, drawn
from a bounded sample of the corpus, together with strings drawn evenly from the usual
alphabets are random; all other words of that sample are ordinary.

Defined results: a null or empty text has no span; repeated rows get a row each; without any
ordinary word in the sample no span is added to the base ones; an empty table gives an empty
table; other columns are not read. Offsets are code points, ends exclusive.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.llm.common import in_share, only, shares, slices

# The base rules, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
MARKOV = "markov"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_KEY_WORDS = ("passw", "secret", "token", "apikey", "api_key")
SEPARATORS = "/=_-"
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
SAMPLE_ROWS = 2_000
GENERATED = 3_000
LEAST_RUN = 20
MIN_RATIO = 0.45  # of log-likelihood per sign


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the base rules: leftmost matches of each kind that do not
    overlap, without those that are too short."""
    found = []
    low = text.lower()
    if any(w in low for w in _KEY_WORDS) or not low.isascii():
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _LONG_ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _codes(run: str) -> list[int]:
    return [_INDEX[c] for c in run]


def _transitions(strings: list[str]) -> np.ndarray:
    """Log-probabilities of a sign after a sign, smoothed."""
    size = len(ALPHABET)
    counts = np.full((size, size), 0.1)
    for s in strings:
        codes = _codes(s)
        np.add.at(counts, (codes[:-1], codes[1:]), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def generated_strings(n: int = GENERATED, seed: int = 5) -> list[str]:
    """Strings drawn evenly from hexadecimal, base-32, base-62 and base-64 alphabets."""
    draw = np.random.default_rng(seed)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[:62], ALPHABET[:64]]
    return ["".join(draw.choice(list(alphabets[i % 4]), 32)) for i in range(n)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Log-likelihood ratio of each transition, random against ordinary, from the labelled
    words of at most `sample_rows` texts (those whose hashed ids are the least)."""
    rows = only(docs, id=id_col, text=text_col)
    hashed = rows.select(F.xxhash64(F.lit("secrets"), F.col("id").cast("string"), F.length("text")).alias("h"))
    for share in shares(rows.count(), sample_rows):
        least = hashed.filter(in_share(F.col("h"), share)).orderBy("h").limit(sample_rows)
        chosen = least.agg(F.max("h").alias("h"), F.count("*").alias("n")).first()
        if chosen.n == sample_rows:
            break
    if chosen.h is None:
        return np.zeros((len(ALPHABET), len(ALPHABET)))
    sample = rows.filter(F.xxhash64(F.lit("secrets"), F.col("id").cast("string"), F.length("text")) <= chosen.h)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            secret, ordinary = set(), set()
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                masked = list(text)
                for kind, start, end in base_spans(text):
                    value = ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
                    secret.add(value.replace(".", ""))
                    masked[start:end] = " " * (end - start)
                ordinary.update(w for w in re.findall(r"[A-Za-z0-9+/_=-]{4,}", "".join(masked)))
            values = [(True, v) for v in secret] + [(False, v) for v in ordinary]
            yield pa.record_batch({"is_secret": pa.array([k for k, _ in values], pa.bool_()), "value": pa.array([v for _, v in values], pa.string())})

    words = sample.select("text").mapInArrow(labelled, "is_secret boolean, value string").distinct()
    counted = words.select("is_secret", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring("value", i, F.lit(2)))).alias("two")).filter(F.length("two") == 2).groupBy("is_secret", "two").agg(F.count("*").alias("n"))
    size = len(ALPHABET)
    counts = {True: np.full((size, size), 0.5), False: np.full((size, size), 0.5)}
    met = False
    for r in counted.collect():  # at most two times the squared alphabet
        if all(c in _INDEX for c in r.two):
            counts[r.is_secret][_INDEX[r.two[0]], _INDEX[r.two[1]]] += r.n
            met = met or not r.is_secret
    if not met:
        return np.zeros((size, size))
    for s in generated_strings():
        codes = _codes(s)
        np.add.at(counts[True], (codes[:-1], codes[1:]), 1)
    random, ordinary = (np.log(c / c.sum(axis=1, keepdims=True)) for c in (counts[True], counts[False]))
    return random - ordinary


def ratio(run: str, model: np.ndarray) -> float:
    """Mean log-likelihood ratio over the run's transitions."""
    codes = _codes(run)
    return float(model[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0


def stretches(gain: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of parts of a run, end exclusive, over whose transitions the gains add up to
    no less than 0: the greatest sum of at least `LEAST_RUN` signs, then what is left of it and
    right of it in the same way."""
    least = LEAST_RUN - 1
    open_ = [(0, len(gain))]
    while open_:
        low, high = open_.pop()
        if high - low < least:
            continue
        sums = np.concatenate([[0.0], np.cumsum(gain[low:high])])
        # For each end, the least sum before a start that is far enough.
        before = np.minimum.accumulate(sums[:-least])
        end = int((sums[least:] - before).argmax())
        if sums[end + least] < before[end]:
            continue
        start = int(sums[: end + 1].argmin())
        yield low + start, low + end + least + 1
        open_ += [(low, low + start - 1), (low + end + least + 1, high)]


def markov_spans(text: str, model: np.ndarray, least: float = MIN_RATIO) -> list[tuple[str, int, int]]:
    """Long runs, or parts of them, that look drawn at random: some letter and a high ratio."""
    found = []
    for m in _RUN.finditer(text):
        run = m[0]
        if not any(c.isalpha() for c in run):
            continue
        codes = _codes(run)
        gain = model[codes[:-1], codes[1:]] - least
        if gain.mean() >= 0:
            found.append((MARKOV, m.start(), m.end()))
            continue
        spans = []
        for start, end in stretches(gain):
            if any(c.isalpha() for c in run[start:end]):
                while start and run[start - 1] not in SEPARATORS:
                    start -= 1
                while end < len(run) and run[end] not in SEPARATORS:
                    end += 1
                spans.append((start, end))
        at = 0
        for start, end in sorted(spans):
            if end > at:
                found.append((MARKOV, m.start() + max(start, at), m.start() + end))
                at = end
    return found


def all_spans(text: str, model: np.ndarray, least: float = MIN_RATIO) -> list[tuple[str, int, int]]:
    """Base spans and those that the model adds; a run that a base span touches adds none."""
    base = base_spans(text)
    added = [s for s in markov_spans(text, model, least) if not any(b[1] < s[2] and s[1] < b[2] for b in base)]
    return sorted(base + added, key=lambda s: (s[1], (*KINDS, MARKOV).index(s[0])))


def scan(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", least: float = MIN_RATIO) -> DataFrame:
    """doc_id and secrets, an array of (kind, start, end), for every row of `docs`."""
    docs = only(docs, doc_id=id_col, text=text_col)
    kind = dict(docs.dtypes)["doc_id"]
    inner = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 1 << 23):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in all_spans(t or "", model, least)] for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "secrets": pa.array(spans, inner)})

    return docs.mapInArrow(scanned, f"doc_id {kind}, secrets array<struct<kind:string,start:long,end:long>>")


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _of_kind(kind: str):
    return lambda span: span.getField("kind") == F.lit(kind)


def summary(scanned: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""
    base = F.filter("secrets", lambda s: s.getField("kind") != F.lit(MARKOV))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string"))), ",")

    counts = [F.size(F.filter("secrets", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return scanned.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def redact(docs: DataFrame, model: np.ndarray, text_col: str = "text", mark: str = "<SECRET>", least: float = MIN_RATIO) -> DataFrame:
    """All columns of `docs`, with each span of the text replaced by a mark; spans that
    overlap become one mark, a null text stays null."""
    place = docs.columns.index(text_col)
    schema = docs.schema

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place, 1 << 23):
            texts = []
            for text in batch.column(place).to_pylist():
                if text:
                    parts, at = [], 0
                    for _, a, b in all_spans(text, model, least):
                        if a >= at:
                            parts += [text[at:a], mark]
                        at = max(at, b)
                    text = "".join(parts) + text[at:] if parts else text
                texts.append(text)
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(redacted, schema)

