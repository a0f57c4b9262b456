"""Conversation repair, benchmark leaks and spelling variants against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from levyscan.llm import spelling_variants, suffix_automaton, turn_repair

EXTRA = ", n long, id long, kind int, fault string, spans string, word string, _conv long"
NOISE = (1, 2, 3, "x", "y", "z", 4)


# --- conversations --------------------------------------------------------------------------
def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "" if ink[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def plain_repairs(rows, most_added=2):
    """All edits of a short conversation, the cheapest and least of them."""
    faults = plain_faults(rows)
    best = None
    steps = []
    for (role, _), fault in zip(rows, faults):
        short = 3 if fault == "truncated" else 0
        ways = [("D", 4, "")]
        if fault not in ("blank", "duplicate"):
            ways += [("K", short, role[:1])] if role else []  # a row without a role cannot stay as it is
            ways += [("R", 3 + short, "u"), ("R", 3 + short, "a")]
        steps.append(ways)
    gaps = [("I" * k, 3 * k, "".join(p)) for k in range(most_added + 1) for p in itertools.product("ua", repeat=k)]
    for way in itertools.product(gaps, *[x for ways in steps for x in (ways, gaps)]):
        roles = "".join(w[2] or "" for w in way)
        if re.fullmatch("(s?(ua)+)?", roles):
            found = (sum(w[1] for w in way), "".join(w[0] for w in way))
            best = min(best or found, found)
    return best


def plain_viterbi(rows):
    """The same by whole strings per state, for longer conversations."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def add(states):
        for _ in range(3):
            for state, (cost, said) in list(states.items()):
                for made in "ua":
                    to = moves.get((state, made))
                    if to and (to not in states or (cost + 3, said + "I") < states[to]):
                        states[to] = (cost + 3, said + "I")
        return states

    states = add({"": (0, "")})
    for (role, _), fault in zip(rows, plain_faults(rows)):
        new = {}
        for state, (cost, said) in states.items():
            offers = [(state, cost + 4, said + "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                offers += [(moves.get((state, role[:1])), cost + more, said + "K")]
                offers += [(moves.get((state, m)), cost + more + 3, said + "R") for m in "ua"]
            for to, price, text in offers:
                if to is not None and (to not in new or (price, text) < new[to]):
                    new[to] = (price, text)
        states = add(new)
    return min(states[s] for s in ("", "a") if s in states)


def decoded(rows):
    decoder, said = turn_repair.Decoder(), []
    most = 0

    def size(node):
        return 1 + sum(map(size, node.kids))

    for (role, text), fault in zip(rows, plain_faults(rows)):
        said += decoder.read(turn_repair._Row(0, role, text, fault))
        most = max(most, size(decoder.root))
    said += decoder.finish()
    cost = 0
    for letter, row, _ in said:
        cost += {"D": 4, "I": 3, "R": 3, "K": 0}[letter] + (3 if row is not None and letter != "D" and row.short else 0)
    return (cost, "".join(s[0] for s in said)), most


ROLES = ["user", "assistant", "system", "tool", ""]
TEXTS = ["one.", "two.", "cut", "", " \t", "three!"]


def test_decoder_against_all_edits():
    draw = random.Random(4)
    for _ in range(60):
        rows = [(draw.choice(ROLES), draw.choice(TEXTS)) for _ in range(draw.randint(0, 3))]
        assert decoded(rows)[0] == plain_repairs(rows), rows


def test_decoder_against_plain_viterbi():
    draw = random.Random(5)
    for _ in range(400):
        rows = [(draw.choice(ROLES[: draw.randint(1, 5)]), draw.choice([f"{i}.", *TEXTS])) for i in range(draw.randint(1, 40))]
        assert decoded(rows)[0] == plain_viterbi(rows), rows


def test_decoder_holds_little():
    good = [("user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(5000)]
    assert decoded(good)[1] < 20
    blank = [("user", "")] * 5000
    assert decoded(blank)[1] < 20
    (cost, audit), _ = decoded([("tool", f"{i}.") for i in range(900)])  # undecided up to its end
    assert (cost, set(audit)) == (2700, {"R"})


def plain_digest(rows):
    """rows (turn, role, text) of one conversation after damage, in order"""
    turns = [t for t, _, _ in rows if t is not None]
    faults = plain_faults([r[1:] for r in rows])
    cost, audit = plain_viterbi([r[1:] for r in rows])
    left, out = iter(rows), []
    total = len(audit.replace("D", ""))
    for letter in audit:
        row = next(left) if letter != "I" else None
        if letter == "D":
            continue
        made = "user" if (len(out) - total % 2) % 2 == 0 else "assistant"
        out.append(f"{row[1] if letter == 'K' else made}:{row[2] if row else ''}")
    heads = [r[1][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def plain_damage(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(6)
    rows = []
    for conv in [*range(150), None]:
        for i in range(draw.randint(1, 9)):
            turn = draw.choice([i, i, i, i + 2, None])
            rows.append((conv, turn, draw.choice([*ROLES[:3], None, "tool"]), draw.choice([f"{i} said.", *TEXTS, None]), *NOISE))
    rows += rows[:20]
    rows.append((next(c for c in range(2000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "Lost.", *NOISE))
    rows += [(1000, i, ["user", "assistant"][i % 2], f"{i} " + "long " * 500 + "end.", *NOISE) for i in range(3000)]
    return rows


def test_conversations(spark, talks):
    frame = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string" + EXTRA)
    got = {r[0]: tuple(r[1:]) for r in turn_repair.damaged_and_repaired(frame).collect()}
    assert got == {conv: plain_digest(rows) for conv, rows in plain_damage(talks).items()}
    assert any(v[-2] == "" for v in got.values())
    repaired = turn_repair.repair(frame)
    assert repaired.columns == ["conv_id", "place", "turn", "role", "text"]
    per = repaired.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.substring("role", 1, 1).alias("r")))), lambda x: x["r"]), "").alias("roles"))
    assert all(re.fullmatch("s?(ua)+", r.roles) for r in per.collect())
    assert turn_repair.damaged_and_repaired(frame.limit(0)).count() == 0
    assert turn_repair.repair(frame.limit(0)).count() == 0


# --- leaks ------------------------------------------------------------------------------------
def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_leaks(docs, items, window):
    out = []
    for doc, text, *_ in docs:
        words, hit, found = words_of(text), set(), set()
        for item, body in items:
            own = words_of(body)
            k = min(window, len(own))
            runs = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in runs:
                    hit |= set(range(i, i + k))
                    found.add(item)
        out.append((doc, len(words), tuple(sorted(hit)), tuple(sorted(found, key=str))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def leaky():
    draw = random.Random(8)
    pool = ["a", "b", "cé", "Δ", "x1", "longerwordthansixteenletters", "longerwordthatsixteenletters", "c"]

    def prose(n):
        return draw.choice([" ", ", ", "-", "\n"]).join(draw.choice(pool) for _ in range(n))

    items = [(i, prose(draw.randint(4, 30))) for i in range(30)] + [(1, prose(12)), (40, None), (41, ""), (42, " ,. ")]
    items += [(7, items[3][1])]
    docs = [(i, prose(draw.randint(0, 60)), *NOISE) for i in range(150)]
    for i in range(40):
        body = draw.choice(items[:30])[1].split()
        docs.append((200 + i, f"{prose(5)} | {' '.join(body).upper()} | {prose(7)}", *NOISE))
    docs += [(300, None, *NOISE), (301, "", *NOISE), (None, docs[-3][1], *NOISE), docs[3], docs[3], (302, prose(30_000), *NOISE)]
    return docs, items


@pytest.mark.parametrize("window,block", [(10, 200_000), (4, 60), (1, 200_000), (6, 200)])
def test_leaks(spark, leaky, window, block):
    docs, items = leaky
    if window == 10:
        items = [i for i in items if len(words_of(i[1])) > 6 or not words_of(i[1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string" + EXTRA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = suffix_automaton.find_leaks(frame, bench, window=window, block_words=block).collect()
    got = []
    for r in rows:
        hit = [p for s in r.spans for p in range(s.first, s.last)]
        assert len(hit) == len(set(hit)) and len(set(r["items"])) == len(r["items"])
        got.append((r.doc_id, r.n_words, tuple(sorted(hit)), tuple(sorted(r["items"], key=str))))
    assert sorted(got, key=str) == plain_leaks(docs, items, window)


def test_leak_parts(spark, leaky, monkeypatch):
    docs, items = leaky
    monkeypatch.setattr(suffix_automaton, "PART_WORDS", 5)
    frame = spark.createDataFrame(docs[:100], "doc_id long, text string" + EXTRA)
    rows = suffix_automaton.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string"), window=6, block_words=90).collect()
    got = [(r.doc_id, r.n_words, tuple(p for s in r.spans for p in range(s.first, s.last)), tuple(sorted(r["items"], key=str))) for r in rows]
    assert sorted(got, key=str) == plain_leaks(docs[:100], items, 6)


def test_leaks_removed(spark):
    item = "the quick brown fox jumps over the lazy dog near a river bank"
    around = "Ünder " + " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"{around}. {item.upper()}! after all", *NOISE), (2, f"so {item}", *NOISE), (3, around, *NOISE), (4, None, *NOISE), (5, "", *NOISE)]
    frame = spark.createDataFrame(docs, "doc_id long, text string" + EXTRA)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in suffix_automaton.remove_leaks(frame, bench).collect()}
    assert {k: r.text for k, r in got.items()} == {1: f"{around}. ! after all", 3: around, 4: None, 5: ""}
    assert got[1].kind == 3 and got[1].spans == "y"
    assert suffix_automaton.find_leaks(frame.limit(0), bench).count() == 0
    nothing = suffix_automaton.find_leaks(frame, bench.limit(0)).collect()
    assert {(r.doc_id, len(r.spans)) for r in nothing} == {(i, 0) for i in range(1, 6)}


# --- spelling ---------------------------------------------------------------------------------
def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=10):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def test_variants(spark):
    draw = random.Random(9)
    counts = {}
    for base in ["aaaaaaa", "abababab", "recommend", "straßenbau", "internationalisation", "x" * 300]:
        family = {base}
        for _ in range(60):
            w = draw.choice(sorted(family))
            i = draw.randrange(len(w) + 1)
            letter = draw.choice("abeéß")
            family.add(draw.choice([w[:i] + letter + w[i:], w[:i] + w[i + 1 :], w[:i] + letter + w[i + 1 :]]))
        counts |= {w: draw.choice([2, 3, 20, 30, 300, 4000]) for w in family if len(w) >= 7}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in spelling_variants.group_variants(frame).collect()}
    assert got == plain_variants(counts)
    assert spelling_variants.group_variants(frame.limit(0)).count() == 0
    assert spelling_variants.group_variants(frame.limit(1)).count() == 1


def test_word_counts(spark):
    draw = random.Random(10)
    pool = ["Recommended", "ÀÉtranger", "recommendEd", "short", "étrangers", "wonderful"]
    rows = [(i, " ".join(draw.choice(pool) for _ in range(20)) + draw.choice(["", "7", "-"]), *NOISE) for i in range(300)]
    rows += [(1000, None, *NOISE), (1001, "", *NOISE), (None, "wonderful wonderful", *NOISE), rows[0], (1002, "wonderfulĀwonderful " * 40_000, *NOISE)]
    frame = spark.createDataFrame(rows, "doc_id long, text string" + EXTRA)
    plain = {}
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                plain[run] = plain.get(run, 0) + 1
    got = {r.word: r.n for r in spelling_variants.word_counts(frame, slip_one_in=31).collect()}
    assert got == {w: n for w, n in plain.items() if n >= 2}
    whole = spelling_variants.word_counts(frame).collect()
    assert {r.word for r in whole} == {"recommended", "ÀÉtranger", "étrangers", "wonderful"}
    assert spelling_variants.word_counts(frame.limit(0)).count() == 0
