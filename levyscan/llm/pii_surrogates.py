"""PII surrogates: detected entities are replaced by keyed ones of the same kind and form.

A surrogate is drawn from an HMAC of the key, the kind, the entity's canonical form and an
attempt number, so an entity has the same surrogate wherever it stands, and nothing can be
told from it without the key. Digits become digits, letters become letters of their script
and case, and what carries the form stays: separators, country codes, the check digits of
cards and bank accounts (made valid anew), the number of digits of each part of an address.
An entity that still clashes after `WIDEN_AFTER` draws (a form may have fewer values than the
table has entities of it) gives up some of its form: an address the numbers of digits, other
kinds their length, which grows by a sign with each `WIDEN_AFTER` draws.
People get names of the gender of their title or given name, in their script; each part of a
name has a surrogate of its own. Who is named in a text with a title or a listed given name is
replaced wherever a part of the name (or of its hyphens) stands there as a capitalised word of
its own, before or after, so a person met again by surname alone stays the same one.
Mail addresses keep a surrogate domain in common where their domains were the same.

Distinctness is checked over the whole table: two entities of a kind with one surrogate, or a
surrogate that is itself an entity of the table, make all but the first draw again, until no
clash is left. Only entities that drew again travel to the texts; the texts themselves are
not shuffled. Entities and their clashes stay in Spark; the list of redrawn ones is sent to
the tasks if it has at most `MAX_REDRAWN` rows, else it is joined by text.

Defined results: a null text stays null with no entity, an empty one stays empty; repeated
rows get the same result; an empty table gives an empty table; other columns are not read.
"""

import hashlib
import hmac
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levyscan.llm.common import only, slices, stage

MAX_REDRAWN = 100_000
MAX_ROUNDS = 40
WIDEN_AFTER = 4  # draws in an entity's own form, before the form gives way
KINDS = ("email", "iban", "card", "ssn", "ip", "phone", "given_f", "given_m", "given", "surname")

# Titles by gender, given names by gender, and syllables by script.
TITLES = {
    "f": "Mrs Ms Miss Madam Mme Mlle Madame Frau Señora Sra Doña г-жа госпожа κυρία".split(),
    "m": "Mr Sir Monsieur Herr Señor Sr Don г-н господин κύριος".split(),
    "": "Dr Prof".split(),
}
GIVEN = {
    "f": "Mary Anna Emma Laura Julia Sarah Marie Sophie Claire Elena María Carmen Lucía Ana Anne Katharina Ольга Анна Мария Елена Μαρία Ελένη".split(),
    "m": "John James Robert Michael David Peter Paul Thomas Pierre Jean Hans Klaus José Juan Carlos Luis Иван Пётр Дмитрий Сергей Γιώργος Νίκος".split(),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ge ha he ja je ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi wa we za".split(),
    "cyrillic": "ба бе би бо ва ве ви во га ге да де ди до за зе ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со та те ти то".split(),
    "greek": "βα βε βι βο γα γε δα δε δι δο ζα ζε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(),
}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "n", ("cyrillic", "f"): "а", ("cyrillic", "m"): "н", ("greek", "f"): "α", ("greek", "m"): "ς"}

_NUMBER = regex.compile(
    r"""(?<![\w.+-])(?:(?P<iban>[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?)
    |(?P<ip>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d))
    |(?P<card>\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7})
    |(?P<ssn>\d{3}-\d{2}-\d{4})
    |(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}|\+\d{8,15}))(?![\w-]|\.\d)""",
    regex.X,
)
_LOCAL = regex.compile(r"[\p{L}\d._%+-]+$")
_DOMAIN = regex.compile(r"[\p{L}\d-]+(?:\.[\p{L}\d-]+)*\.\p{L}{2,}")
_PART = r"\p{Lu}(?:\p{L}|(?!['’][sS](?!\p{L}))['’-](?=\p{L}))+"  # without the 's of a genitive
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_GIVEN = "|".join(g for gs in GIVEN.values() for g in gs)
_LATER = rf"\s(?!(?:{_TITLE})\.?\s+\p{{Lu}})"  # the next person's title is no part
_THIRD = rf"(?:{_LATER}(?!(?:{_GIVEN})\s\p{{Lu}}){_PART})?"
_NAMED = regex.compile(rf"(?<!\w)(?:(?P<title>{_TITLE})\.?\s+(?P<parts>{_PART}(?:{_LATER}{_PART}{_THIRD})?)|(?P<given>{_GIVEN})\s(?P<last>{_PART}{_THIRD}))(?!\w)")
_CAPITAL = regex.compile(rf"(?<!\w){_PART}(?!\w)")
_PIECE = regex.compile(r"[^-]+")
#: What may be taken for a part of a name at its place, but is none elsewhere.
NO_NAMES = frozenset({t.lower() for ts in TITLES.values() for t in ts} - {"don"}) | frozenset(
    """a an and are as at but by for from has he her his i if in is it its my no not of on or our she so that the their then there these they this to was we were what when where who with you your
    e-mail email fax phone tel telephone das dem den der die ein eine er es ich im ist mit sie und von wir zu au ce dans de des du elle est et il ils je la le les nous pour un une vous
    al como con del el ella en es los las para por que se su una y в и из к на не но он она они по с что это я και ο η το του της στο με για από""".split()
)
_TITLE_HINT = [t for ts in TITLES.values() for t in ts] + [g for gs in GIVEN.values() for g in gs]


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def luhn_digit(digits: str) -> str:
    """The digit that makes digits + digit pass the Luhn check."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of each entity, left to right, none overlapping."""
    found, named = [], {}
    at = text.find("@")
    while at >= 0:
        local = _LOCAL.search(text, max(0, at - 64), at)
        domain = _DOMAIN.match(text, at + 1)
        if local and domain:
            found.append((local.start(), domain.end(), "email", text[local.start() : domain.end()].lower()))
        at = text.find("@", at + 1)
    for m in _NUMBER.finditer(text):
        kind, raw = m.lastgroup, m[0]
        digits = _digits(raw)
        if kind == "iban" and not iban_valid(raw):
            continue
        if kind == "card" and not 13 <= len(digits) <= 19:
            continue
        if kind == "phone" and not (9 <= len(digits) <= 15 or (raw[0] in "+(" and 8 <= len(digits) <= 15)):
            continue
        canonical = raw.replace(" ", "") if kind == "iban" else raw if kind == "ip" else ("+" if raw[0] == "+" else "") + digits
        found.append((m.start(), m.end(), kind, canonical))
    if any(t in text for t in _TITLE_HINT):
        for m in _NAMED.finditer(text):
            given = m["given"]
            first = m.start("parts") if m["title"] else m.start("given")
            parts = [(w.start() + first, w[0]) for w in regex.finditer(_PART, text[first : m.end()])]
            gender = next((g for g, ts in TITLES.items() if m["title"] in ts), "") if m["title"] else next(g for g, ns in GIVEN.items() if given in ns)
            if not gender:
                gender = next((g for g, ns in GIVEN.items() if parts[0][1] in ns), "")
            for i, (start, name) in enumerate(parts):
                kind = "surname" if i == len(parts) - 1 else f"given_{gender}" if gender else "given"
                found.append((start, start + len(name), kind, name.lower()))
                named.setdefault(name.lower(), kind)
    if named:
        for name, kind in list(named.items()):
            for piece in name.split("-"):
                if len(piece) > 1:
                    named.setdefault(piece, kind)
        for m in _CAPITAL.finditer(text):
            # A compound that is no name itself may have one in it.
            for w in [m] if m[0].lower() in named else _PIECE.finditer(text, m.start(), m.end()):
                name = w[0].lower()
                if w[0][0].isupper() and name in named and name not in NO_NAMES:
                    found.append((w.start(), w.end(), named[name], name))
    out, end = [], 0
    for span in sorted(found, key=lambda s: (s[0], -s[1])):
        if span[0] >= end:
            out.append(span)
            end = span[1]
    return out


class _Draw:
    """An endless row of numbers from a key and a text."""

    def __init__(self, key: bytes, *parts: str):
        self._seed, self._n, self._held = hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self._held) < 4:
            self._held = hashlib.sha256(self._seed + self._n.to_bytes(4, "big")).digest()
            self._n += 1
        value, self._held = int.from_bytes(self._held[:4], "big"), self._held[4:]
        return value % n


def _like(text: str, draw: _Draw) -> str:
    """Signs of the same sort, one for one; other signs stay."""
    out = []
    for i, c in enumerate(text):
        if c.isdigit():
            first = c != "0" and (i == 0 or not text[i - 1].isdigit())
            out.append(str(1 + draw.below(9)) if first else str(draw.below(10)))
        elif c.isalpha():
            base = "abcdefghijklmnopqrstuvwxyz" if c.isascii() else "абвгдежзиклмнопрстуфхцчшэюя" if "Ѐ" <= c <= "ӿ" else "αβγδεζηθικλμνξοπρστυφχψω" if "Ͱ" <= c <= "Ͽ" else "aeioubcdfghlmnprst"
            low = base[draw.below(len(base))]
            out.append(low.upper() if c.isupper() else low)
        else:
            out.append(c)
    return "".join(out)


def _script(name: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in name) else "greek" if any("Ͱ" <= c <= "Ͽ" for c in name) else "latin"


@lru_cache(maxsize=100_000)
def surrogate(kind: str, canonical: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of an entity's canonical form, in canonical form."""
    draw = _Draw(key, kind, canonical, str(attempt))
    longer = attempt // WIDEN_AFTER
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        stem, top = domain.rsplit(".", 1)
        return f"{_like(local + 'a' * longer, draw)}@{_like(stem, _Draw(key, 'domain', domain))}.{top}"
    if kind == "ip":
        if longer:
            return ".".join(str(low + draw.below(high - low + 1)) for low, high in [(1, 223), (0, 255), (0, 255), (0, 255)])
        parts = []
        for i, part in enumerate(canonical.split(".")):
            low, high = {1: (1 if i == 0 else 0, 9), 2: (11 if i == 0 else 10, 99)}.get(len(part), (100, 223 if i == 0 else 255))
            parts.append(str(low + draw.below(high - low + 1)))
        return ".".join(parts)
    if kind == "card":
        body = canonical[0] + _like("9" + canonical[1:-1] + "0" * min(longer, 19 - len(canonical)), draw)[1:]
        valid = luhn_digit(canonical[:-1]) == canonical[-1]
        check = luhn_digit(body)
        return body + (check if valid else str((int(check) + 1 + draw.below(9)) % 10))
    if kind == "iban":
        body = _like(canonical[4:] + "0" * min(longer, 34 - len(canonical)), draw)
        rest = 98 - int("".join(str(int(c, 36)) for c in body + canonical[:2] + "00")) % 97
        return f"{canonical[:2]}{rest:02d}{body}"
    if kind in ("ssn", "phone"):
        return _like(canonical + "0" * longer, draw)
    script = _script(canonical)
    n = 2 + draw.below(2) + attempt // 8
    name = "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(n))
    return name + ENDINGS.get((script, kind[-1]), "") if kind.startswith("given_") else name


def in_form(raw: str, kind: str, canonical: str, new: str) -> str:
    """The surrogate in the form in which the entity stands in a text."""
    if kind in ("email", "iban"):
        body = iter(new)
        if len(new) == len(raw.replace(" ", "")):
            put = [c if c == " " and kind == "iban" else next(body) for c in raw]
            return "".join(p.upper() if c.isupper() else p for c, p in zip(raw, put))
        return new
    if kind == "ip":
        return new
    if kind in ("card", "ssn", "phone"):
        digits = iter(_digits(new))
        # A country code stays as it is.
        code = regex.match(r"\+\d{1,3}(?=[ .(-])", raw)
        keep = code.end() if code else 0
        for _ in _digits(raw[:keep]):
            next(digits)
        return raw[:keep] + "".join(next(digits) if c.isdigit() else c for c in raw[keep:]) + "".join(digits)
    return new.upper() if raw.isupper() and len(raw) > 1 else new[0].upper() + new[1:] if raw[0].isupper() else new


def _shown(kind: str, canonical: str, new: str) -> str:
    """What tells two surrogates of a kind apart: a phone's country code is not drawn, so
    numbers are compared without up to three leading digits."""
    return new[4:] if kind == "phone" and canonical.startswith("+") else new


def entities(docs: DataFrame) -> DataFrame:
    """The distinct (kind, canonical) of all texts."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            met = sorted({(k, c) for t in batch.column(0).to_pylist() if t for _, _, k, c in find(t)})
            yield pa.record_batch({"kind": pa.array([k for k, _ in met], pa.string()), "canonical": pa.array([c for _, c in met], pa.string())})

    return docs.select("text").mapInArrow(listed, "kind string, canonical string").distinct()


def attempts(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt) of the entities that have to draw again, so that no two of a
    kind share a surrogate and no surrogate is an entity of the table."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, names, tries = (batch.column(i).to_pylist() for i in range(3))
            new = [_shown(k, c, surrogate(k, c, key, a)) for k, c, a in zip(kinds, names, tries)]
            yield pa.record_batch({"kind": batch.column(0), "canonical": batch.column(1), "attempt": batch.column(2), "new": pa.array(new, pa.string())})

    schema = "kind string, canonical string, attempt int, new string"
    kind_of = F.when(F.startswith("kind", F.lit("given")), "given").otherwise(F.col("kind"))
    taken = stage(known.select(kind_of.alias("k"), F.when(F.col("kind") == "phone", F.col("canonical").substr(F.lit(5), F.length("canonical"))).otherwise(F.col("canonical")).alias("new")).distinct(), "pii-known")
    now = stage(known.withColumn("attempt", F.lit(0)).mapInArrow(drawn, schema), "pii-drawn")
    for _ in range(MAX_ROUNDS):
        first = F.row_number().over(Window.partitionBy("k", "new").orderBy("attempt", "kind", "canonical"))
        shared = now.withColumn("k", kind_of).join(now.withColumn("k", kind_of).groupBy("k", "new").count().filter("count > 1"), ["k", "new"], "left_semi")
        later = shared.withColumn("first", first).filter("first > 1").select("kind", "canonical")
        real = now.withColumn("k", kind_of).join(taken, ["k", "new"], "left_semi").select("kind", "canonical")
        again = stage(later.unionByName(real).distinct(), "pii-again")
        if not again.limit(1).count():
            break
        redrawn = now.join(again, ["kind", "canonical"], "left_semi").select("kind", "canonical", (F.col("attempt") + 1).cast("int").alias("attempt"))
        now = stage(now.join(again, ["kind", "canonical"], "left_anti").select("kind", "canonical", "attempt", "new").unionByName(redrawn.mapInArrow(drawn, schema)), "pii-drawn")
    else:
        raise RuntimeError(f"surrogates still clash after {MAX_ROUNDS} draws")
    return now.filter("attempt > 0").select("kind", "canonical", "attempt")


def replace(text: str, key: bytes, redrawn: dict[tuple[str, str], int]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates, and (start, end, kind) of what was replaced in it."""
    parts, spans, at = [], [], 0
    for start, end, kind, canonical in find(text):
        new = surrogate(kind, canonical, key, redrawn.get((kind, canonical), 0))
        parts += [text[at:start], in_form(text[start:end], kind, canonical, new)]
        spans.append((start, end, kind))
        at = end
    return "".join(parts) + text[at:], spans


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", max_redrawn: int = MAX_REDRAWN) -> DataFrame:
    """doc_id, text with surrogates, n_entities and entities (kind:start:end in the old text)
    for every row of `docs`."""
    docs = only(docs, doc_id=id_col, text=text_col)
    redrawn = stage(attempts(stage(entities(docs), "pii-entities"), key), "pii-redrawn")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text string, n_entities int, entities string"
    few = redrawn.count() <= max_redrawn
    shared = {(r.kind, r.canonical): r.attempt for r in redrawn.collect()} if few else {}

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 1 << 23):
            own = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
            texts, counts, marks = [], [], []
            for text, rows in zip(batch.column(1).to_pylist(), own):
                known = {(r["kind"], r["canonical"]): r["attempt"] for r in rows} if rows else shared
                new, spans = replace(text, key, known) if text else (text, [])
                texts.append(new)
                counts.append(len(spans))
                marks.append(",".join(f"{k}:{a}:{b}" for a, b, k in spans))
            yield pa.record_batch({"doc_id": batch.column(0), "text": pa.array(texts, pa.string()), "n_entities": pa.array(counts, pa.int32()), "entities": pa.array(marks, pa.string())})

    if few:
        return docs.mapInArrow(replaced, schema)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            met = sorted({(hashlib.md5(t.encode()).hexdigest(), k, c) for t in batch.column(0).to_pylist() if t for _, _, k, c in find(t)})
            yield pa.record_batch({n: pa.array([m[i] for m in met], pa.string()) for i, n in enumerate(("at", "kind", "canonical"))})

    met = docs.select("text").mapInArrow(listed, "at string, kind string, canonical string").distinct().join(redrawn, ["kind", "canonical"])
    per_text = met.groupBy("at").agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("redrawn"))
    joined = docs.withColumn("at", F.md5("text")).join(per_text, "at", "left")
    return joined.select("doc_id", "text", "redrawn").mapInArrow(replaced, schema)
