"""Spelling variants: words one inserted, deleted or replaced letter apart, by trie-node pairs.

Every beginning of a word is a node of a trie, every ending a node of the trie of reversed
words, and nodes have numbers. A word with one place skipped is a pair of integers (node in
front of the place, node behind it); so is a word with a place inserted. Two words that
differ by a replaced letter have a skipped pair in common, a word and one that is a letter
longer share an inserted and a skipped pair. Joining the integers gives all neighbours and
nothing else.

Numbers of nodes need no trie that is held anywhere. Up to seven letters the node is the
letters themselves, packed into one integer. Deeper nodes have the number of the first word
that goes through them, found by one pass over the words sorted within the group of their
first (last) seven letters; the depth is part of the pair. Words have numbers in rising order
of their letters, which so also settle ties.

A pair of nodes has at most as many words as there are letters, 90, so no group is large, and
the pairs of words in a group are never spelt out: each member only needs the size of the
group and its best other member.

Words consist of letters up to U+00FF, seven or more. Defined results: null and empty texts
have no words; repeated rows count each time; a null doc_id is an empty text in the checksum
of `word_counts`; an empty table gives an empty table; other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.llm.common import only, slices, stage

PACKED = 7
LEAST_RATIO = 10
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, slip_one_in: int | None = None, least_letters: int = PACKED, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, of at least `least_letters` letters
    and `least` occurrences in all texts. With `slip_one_in`, a run loses one letter where that
    number divides the checksum of document and run."""
    rows = only(docs, doc_id=id_col, text=text_col)
    # A greedy pattern takes whole runs: a shorter run never has so many letters in a row.
    found = rows.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least_letters},}}"), 0)).alias("run"))
    words = found.select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("word"))
    if slip_one_in:
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
        words = words.withColumn("h", F.crc32(named.cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % slip_one_in == 0, less).otherwise(F.col("word")).alias("word")).filter(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _deep_nodes(words: list[bytes], numbers: list[int], before: tuple[bytes, list[int]]) -> tuple[list[list[int]], tuple[bytes, list[int]]]:
    """For each word in sorted order the numbers of its nodes beyond `PACKED` letters: those of
    the word before it as far as both begin alike, then its own."""
    out = []
    last, nodes = before
    for word, number in zip(words, numbers):
        size = len(word)
        same = PACKED
        if word[:PACKED] == last[:PACKED]:
            most = min(size, len(last))
            while same < most and word[same] == last[same]:
                same += 1
        nodes = nodes[: same - PACKED] + [number] * (size - same)
        out.append(nodes)
        last = word
    return out, (last, nodes)


def number_words(counts: DataFrame) -> DataFrame:
    """(id, word, n, nodes): words numbered in order of their letters, with the numbers of
    their forward nodes beyond seven letters."""
    head = counts.withColumn("head", F.substring("word", 1, PACKED))
    ordered = head.repartitionByRange("head").sortWithinPartitions("head", "word")
    numbered = ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n")

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[bytes, list[int]] = (b"", [])
        for batch in slices(batches, 1, 1 << 18):
            words = [w.encode("latin-1") for w in batch.column(1).to_pylist()]
            nodes, before = _deep_nodes(words, batch.column(0).to_pylist(), before)
            yield batch.append_column("nodes", pa.array(nodes, pa.list_(pa.int64())))

    return stage(numbered.mapInArrow(forward, "id long, word string, n long, nodes array<long>"), "numbered-words")


def _all_nodes(letters: np.ndarray, at: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """The nodes of all words in a row, from none to all letters each (one more than letters).
    `at` is where a word's letters begin, `deep` holds the numbers beyond `PACKED` letters."""
    sizes = np.diff(at)
    first = at[:-1] + np.arange(len(sizes))
    out = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    node = np.ones(len(sizes), np.int64)
    out[first] = node
    for d in range(PACKED):
        node = (node << 8) | letters[at[:-1] + d]
        out[first + d + 1] = node
    depth = np.arange(len(out)) - np.repeat(first, sizes + 1)
    out[depth > PACKED] = deep
    return out


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    return np.frombuffer(b"".join(words), np.uint8).astype(np.int64), at


def node_pairs(numbered: DataFrame) -> DataFrame:
    """(front, front_depth, back, back_depth, kind, n, id) of every word: kind 0 for each place
    where a letter could be inserted, 1 for each skipped letter, 2 for a skipped letter that
    differs from the one before it (skipping either of two equal neighbours gives one word)."""
    tail = F.reverse(F.substring(F.col("word"), -PACKED, PACKED))
    ordered = numbered.withColumn("tail", tail).repartition("tail").sortWithinPartitions("tail", F.reverse("word"))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[bytes, list[int]] = (b"", [])
        for batch in slices(batches, 1, 1 << 16):
            ids = batch.column(0).to_numpy()
            n = batch.column(2).to_numpy()
            words = [w.encode("latin-1") for w in batch.column(1).to_pylist()]
            back_words = [w[::-1] for w in words]
            deep, before = _deep_nodes(back_words, ids.tolist(), before)
            letters, at = _flat(words)
            front = _all_nodes(letters, at, batch.column(3).flatten().to_numpy())
            back = _all_nodes(_flat(back_words)[0], at, np.array([x for nodes in deep for x in nodes], np.int64))
            sizes = np.diff(at)
            first = at[:-1] + np.arange(len(sizes))
            for kind in (0, 1):  # inserted places, then skipped letters
                count = sizes + 1 - kind
                word = np.repeat(np.arange(len(sizes)), count)
                place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                rest = sizes[word] - kind - place
                kinds = np.zeros(len(word), np.int32)
                if kind:
                    own = at[:-1][word] + place
                    kinds += 1 + ((place == 0) | (letters[own] != letters[np.maximum(own - 1, 0)]))
                yield pa.record_batch(
                    {
                        "front": front[first[word] + place],
                        "front_depth": place.astype(np.int32),
                        "back": back[first[word] + rest],
                        "back_depth": rest.astype(np.int32),
                        "kind": kinds,
                        "n": n[word],
                        "id": ids[word],
                    }
                )

    schema = "front long, front_depth int, back long, back_depth int, kind int, n long, id long"
    return ordered.select("id", "word", "n", "nodes").mapInArrow(paired, schema)


_KEY = ["front", "back", "front_depth", "back_depth"]


def _members(kind: np.ndarray, n: np.ndarray, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, near words, n of the best, id of the best) from groups of rows that begin at
    `start`; in a group the inserted place comes first, then skipped letters, best first."""
    size = np.diff(np.append(start, len(kind)))
    run = np.repeat(np.arange(len(start)), size)
    row = np.arange(len(kind))
    skipped = kind > 0
    has_insert = ~skipped[start]
    top = start + has_insert  # the best skipped one
    skips = size - has_insert
    out = []
    # A replaced letter: skipped ones among themselves.
    swap = skipped & (skips[run] > 1)
    other = np.where(row == top[run], top[run] + 1, top[run])[swap]
    out.append((ids[swap], (skips[run] - 1)[swap], n[other], ids[other]))
    # A letter more: the inserted place and the skipped letters that count once.
    once = (kind == 2) & has_insert[run]
    out.append((ids[once], np.ones(int(once.sum()), np.int64), n[start[run[once]]], ids[start[run[once]]]))
    rows = np.flatnonzero(once)
    groups, begin, times = np.unique(run[rows], return_index=True, return_counts=True)
    best = rows[begin]
    out.append((ids[start[groups]], times, n[best], ids[best]))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*out))


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, form_n, form): how many words are one letter away from a word, and the most
    frequent of them (the least by letters, if several). Words without any are left out."""
    ordered = pairs.repartition(*_KEY).sortWithinPartitions(*_KEY, F.col("kind") > 0, F.desc("n"), "id")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None

        def members(rows: pa.RecordBatch) -> pa.RecordBatch:
            keys = [rows.column(c).to_numpy() for c in _KEY]
            new = np.ones(rows.num_rows, dtype=bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(new)))
            several = np.repeat(size > 1, size)
            kind, n, ids = [rows.column(c).to_numpy()[several] for c in ("kind", "n", "id")]
            parts = _members(kind, n, ids, np.flatnonzero(new[several])) if len(kind) else [np.empty(0, np.int64)] * 4
            return pa.record_batch(dict(zip(["id", "n_near", "form_n", "form"], parts)))

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            same = np.all([batch.column(c).to_numpy() == batch.column(c)[-1].as_py() for c in _KEY], axis=0)
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = batch.slice(last)
            if last:
                yield members(batch.slice(0, last))
        if held is not None:
            yield members(held)

    found = ordered.mapInArrow(met, "id long, n_near long, form_n long, form long").filter("n_near > 0")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    whole = found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return whole.select("id", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): where the chain of forms ends. Each round doubles the steps; a form has ten
    times the occurrences of its word, so chains are short and without circles."""
    steps = stage(forms.select("id", F.col("form").alias("root")), "forms")
    while True:
        beyond = steps.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        moved = stage(steps.join(beyond, F.col("root") == F.col("_id"), "left").select("id", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        if not moved.filter("moved").limit(1).count():
            return moved.select("id", "root")
        steps = moved.select("id", "root")


def group_variants(counts: DataFrame, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row (word, n) of `counts`. The form is the
    near word with most occurrences, if it has at least `least_ratio` times the word's own;
    the root is the last of the chain of forms, the word itself if it has none."""
    words = number_words(counts)
    near = stage(near_words(node_pairs(words)), "near-words")
    plain = words.select("id", "word", "n")
    forms = near.join(plain.select("id", "n"), "id").filter(F.col("form_n") >= F.col("n") * least_ratio).select("id", "form", "form_n")
    forms = stage(forms, "variant-forms")
    roots = _roots(forms)
    form_word = plain.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    root_word = plain.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = forms.join(form_word, "form").join(roots, "id").join(root_word, "root").select("id", "form_word", "root_word", "form_n")
    return (
        plain.join(near.select("id", "n_near"), "id", "left")
        .join(named, "id", "left")
        .select(
            "word",
            F.col("form_word").alias("form"),
            F.coalesce("root_word", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
