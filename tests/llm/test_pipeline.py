"""The pipeline as a chain: what each stage keeps, against plain versions of its decision."""

import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from levyscan.llm import language_id, mixing, secret_markov
from levyscan.llm.common import stage
from levyscan.llm.wordpieces import WordTokenizer, default_tokenizer_path

ENGLISH = "the of and to in that is was for it with as his on be at by had not are but from or have they which one you were all her she there would their we him been has when who will no more if out so what up said".split()
FRENCH = "le être à la forêt où garçon près élève déjà les des une dans qui sur avec pour pas plus nous vous leur même été très aussi comme sans sous chez après depuis toujours jamais où voilà cœur".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, bucket string, h long, row int"
KEY = "token = 1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae"


def prose(seed: int, n: int, words: list[str]) -> str:
    return " ".join(np.random.default_rng(seed).choice(words, n))


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    texts = [prose(i, 60 + i % 7 * 20, FRENCH if i % 3 == 0 else ENGLISH) for i in range(60)]
    texts[10] += f" {KEY} and more"
    texts += [texts[4], texts[4].upper(), texts[5] + " more", None, "", " \n ", "12 34 -- 56", prose(99, 6_000, ENGLISH)]
    rows = [(i, t, "fr" if i % 3 == 0 else "en", [None, "a", "b"][i % 4 % 3], len(t or ""), 7, "x", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, prose(7_000, 90, ENGLISH), None, "a", 1, None, None, None, None)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_survivors(rows):
    """One row of each class of linked texts: that of the least id, nulls last."""
    sets, root = [shingles(r.text) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    classes = {}
    for r, c in zip(rows, root):
        classes.setdefault(c, []).append((r.doc_id is None, r.doc_id))
    return Counter(min(ids, key=lambda i: (i[0], i[1] or 0))[1] for ids in classes.values())


def test_stages_against_plain_versions(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet")
    frames = [docs]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(apply(spark, frames[-1], base), f"test-{name}"))
        assert frames[-1].columns == docs.columns and frames[-1].dtypes == docs.dtypes
    rows = [f.collect() for f in frames]

    model = tuple(sorted((k, v.decode().lower().encode()) for k, v in language_id.train(docs, docs["doc_id"].isNotNull() | docs["doc_id"].isNull()).items()))
    decided = [(r, language_id.decide(r.text, model)) for r in rows[0]]
    assert Counter(rows[1]) == Counter(r for r, (lang, _, margin) in decided if lang != "und" and margin >= language_id.MIN_MARGIN)
    gone = Counter(r.doc_id for r in rows[0]) - Counter(r.doc_id for r in rows[1])
    assert {63, 64, 65, 66} <= set(gone) and len(rows[1]) >= 60

    assert Counter(r.doc_id for r in rows[2]) == plain_survivors(rows[1])
    assert {60, 61, 62}.isdisjoint(r.doc_id for r in rows[2]) and Counter(r.doc_id for r in rows[2])[8] == 1
    assert set(rows[2]) <= set(rows[1])

    before = {r.doc_id: r for r in rows[2]}
    assert Counter(r.doc_id for r in rows[3]) == Counter(r.doc_id for r in rows[2])
    for r in rows[3]:
        assert secret_markov.base_spans(r.text) == [] and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id].text or r.doc_id == 10
    assert KEY.split()[-1] not in next(r.text for r in rows[3] if r.doc_id == 10)

    size = {r.doc_id: len(r.text.split()) for r in rows[3]}
    sources, taken = Counter(), Counter()
    for r in rows[3]:
        sources[r.source] += size[r.doc_id]
    for r in rows[4]:
        taken[r.source] += size[r.doc_id]
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 2 and set(rows[4]) <= set(rows[3])
    # A document is taken whole or not: no farther from the target than half of the largest.
    for source, goal in mixing.targets(list(sources.items())).items():
        assert abs(taken[source] - goal) <= max(size[r.doc_id] for r in rows[3] if r.source == source) / 2 + 1

    pieces = corpus_pipeline.STAGES[-1][1](spark, frames[-1], base).collect()
    ours = WordTokenizer(default_tokenizer_path())
    tokens = Counter()
    for r in rows[4]:
        tokens[r.doc_id] += len(ours.whole(r.text)) + 1
    packed, sequences = Counter(), {}
    for p in pieces:
        packed[p.doc_id] += p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert packed == tokens
    for parts in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096

    whole = corpus_pipeline.run(spark, base)
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32) for p in whole.collect()) == Counter((p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
