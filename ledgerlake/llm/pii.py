"""Operator 3: personal data replaced by keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import attach, checkpointed, table, whole_rows, written

KEY = b"replace this key in production"
ROUNDS = 40

# Given names by gender and script, and titles.
GIVEN = {
    ("f", "latin"): "Alice Anna Carmen Claire Elena Emily Emma Greta Ingrid Isabel Julia Laura Lucia Maria Marie Martha Monika Nina Olivia Paula Rosa Sarah Sophie Susan Teresa".split(),
    ("m", "latin"): "Albert Andrew Antonio Carlos Charles Daniel David Erik Felix Frank George Hans Henri James John Jorge Jules Karl Lukas Manuel Martin Michael Otto Paul Peter Robert Simon Stefan Thomas William".split(),
    ("f", "cyrillic"): "Анна Вера Галина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("m", "cyrillic"): "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Павел Сергей".split(),
}
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora Sr Sra Mme г-н г-жа".split()
SYLLABLES = {
    "latin": "ba bel cor dan del far gan hol kan lam len mar mon nor pel ram ros sal tam ven wil zan".split(),
    "cyrillic": "ба бел вор гал дан зор кам лен мар нов пал рос сам тор фед".split(),
}

_KIND = {name: (gender, script) for (gender, script), names in GIVEN.items() for name in names}
# words that are no mention of a family name in small letters, even where one like them was found ("Peter And The Wolf")
_COMMON = set("a an and as at by for from had has he her his in is it of on or said she that the then they this to was were who will with".split())


def _letters(script: str, kinds: str) -> str:
    """The letters of a script and of some Unicode categories, for a character class."""
    places = [*range(0x41, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00)]
    return "".join(chr(c) for c in places if unicodedata.category(chr(c)) in kinds.split() and unicodedata.name(chr(c)).startswith(script))


def _name(script: str) -> str:
    upper, both = f"[{_letters(script, 'Lu Lt')}]", f"[{_letters(script, 'Lu Lt Ll')}\u0300-\u036f]"
    return f"(?:{upper}['’])?{upper}{both}+(?:[-'’]{upper}{both}+)*"  # a possessive's one letter is no part of it


_FAMILY = f"(?:{_name('LATIN')}|{_name('CYRILLIC')})"
_GAP = r"[ \t\xa0]+"
_INITIALS = rf"(?:[^\W\d_]\.[ \t\xa0]*|[^\W\d_]{_GAP})*"
_PERSON = re.compile(rf"(?<!\w)(?P<given>{'|'.join(sorted(_KIND, key=len, reverse=True))}){_GAP}{_INITIALS}(?P<family>{_FAMILY})(?!\w)")
_TITLED = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, TITLES))})\.?{_GAP}{_INITIALS}(?P<family>{_FAMILY})(?!\w)")
_WORD = re.compile("(?:[^\\W\\d_][\u0300-\u036f]*)+(?:[-'’](?:[^\\W\\d_][\u0300-\u036f]*)+)*")
_PART = re.compile("[^-'’]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_TITLE_WORDS = {t.split("-")[0] for t in TITLES}
_EMAIL = re.compile(r"(?<![\w.%+-])[A-Za-z0-9][\w.%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", re.ASCII)
_NUMBERS = re.compile(
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ -]?\d{2,4}){2,4}(?!\d)|(?<![\w])\(\d{3}\)[ -]?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w])\d(?:[ -]?\d){12,18}(?![\w]))",
    re.ASCII,
)
_SECRETS = re.compile(r"(?P<awskey>(?<!\w)AKIA[A-Z0-9]{16}(?!\w))|(?<!\w)(?:password|passwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*[\"']?(?P<secret>[A-Za-z0-9+/_-]{8,})", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _key(name: str) -> str:
    """What all spellings of a name share: case, the kind of apostrophe and of accents don't count."""
    return unicodedata.normalize("NFC", name).replace("’", "'").casefold()


def _mentions(text: str, names: dict[str, tuple[str, str]]) -> list[tuple[int, int, str, str]]:
    """Mentions of ``names`` (key -> kind and value) in words: whole, as parts of compounds, with a possessive."""
    found = []
    for m in _WORD.finditer(text):
        parts = [(p.start() + m.start(), p.end() + m.start()) for p in _PART.finditer(m[0])]
        i = 0
        while i < len(parts):
            for j in range(len(parts), i, -1):
                start, end = parts[i][0], parts[j - 1][1]
                word = text[start:end]
                known = names.get(_key(word))
                if not known and word[0].isupper() and len(word) > 3 and word[-1] in "sS":  # genitives without apostrophe
                    known, end = names.get(_key(word[:-1])), end - 1
                    word = word[:-1]
                if known and word not in _COMMON:
                    found.append((start, end, *known))
                    i = j
                    break
            else:
                i += 1
    return found


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities of a text, in order, without overlap.

    A value is what mentions of one entity share: e-mail addresses in lower case, the digits of numbers, a
    name's parts each on their own (so that "Anna Weber" and "Frau Weber" keep their common part). The names of
    a person found are replaced wherever the text has them, in any case, alone, in compounds and possessives.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if any(c in text for c in "0123456789"):
        for m in _NUMBERS.finditer(text):
            kind = m.lastgroup or ""
            digits = "".join(c for c in m[0] if c.isdigit())
            if kind == "card" and not luhn(digits) and len(digits) < 15:
                continue
            found.append((m.start(), m.end(), kind, m[0] if kind == "ip" else digits))
        for m in _SECRETS.finditer(text):
            g = m.lastgroup or ""
            found.append((m.start(g), m.end(g), g, m[g]))
    words = set(_LETTERS.findall(text))
    given: dict[str, tuple[str, str]] = {}
    names: dict[str, tuple[str, str]] = {}
    if not words.isdisjoint(_KIND):
        for m in _PERSON.finditer(text):
            gender, script = _KIND[m["given"]]
            if _script(m["family"]) == script:
                given[_key(m["given"])] = f"given {gender} {script}", m["given"]
                names[_key(m["family"])] = f"family {script}", _key(m["family"]).capitalize()
    if not words.isdisjoint(_TITLE_WORDS):
        for m in _TITLED.finditer(text):
            if m["family"] not in _KIND:
                names[_key(m["family"])] = f"family {_script(m['family'])}", _key(m["family"]).capitalize()
    if names:
        found += _mentions(text, {**names, **given})
    out: list[tuple[int, int, str, str]] = []
    for e in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class _Draw:
    """Numbers from a keyed stream for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        self.key, self.seed, self.n = key, f"{kind}\0{value}\0{attempt}".encode(), 0

    def below(self, n: int) -> int:
        self.n += 1
        return int.from_bytes(hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()[:8], "big") % n

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits, all else as it is."""
        kinds = (("0123456789", "0", "9"), ("abcdefghijklmnopqrstuvwxyz", "a", "z"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A", "Z"))
        return "".join(next((s[self.below(len(s))] for s, lo, hi in kinds if lo <= c <= hi), c) for c in text)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The surrogate value of an entity; other attempts give others, except for given names.

    Given names follow a keyed cycle through those of their gender and script: none keeps its own, no two meet.
    """
    d = _Draw(key, kind, value, attempt)
    if kind.startswith("given"):
        _, gender, script = kind.split(" ")
        cycle = sorted(GIVEN[gender, script], key=lambda x: hmac.new(key, x.encode(), hashlib.sha256).digest())
        return cycle[(cycle.index(value) + 1) % len(cycle)]
    if kind.startswith("family"):
        parts = SYLLABLES[kind.split(" ")[1]]
        return "".join(parts[d.below(len(parts))] for _ in range(4 + attempt // 8)).capitalize()
    if kind == "email":
        local, _, domain = value.partition("@")
        *labels, top = domain.split(".")
        return f"{d.like(local)}@{'.'.join(d.like(x) for x in labels)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + d.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + d.like(value[1:-1])
        return body + next((c for c in "0123456789" if luhn(body + c) == luhn(value)), "0")
    if kind == "phone":  # the first digit stays (of the country code), others keep to 2-9 where an area code would
        return value[0] + "".join(str(2 + d.below(8)) if i in (0, 3) else str(d.below(10)) for i in range(len(value) - 1))
    if kind == "ssn":
        return d.like(value)
    if kind == "awskey":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[d.below(32)] for _ in value[4:])
    if re.fullmatch(r"[0-9a-f]+", value):
        return "".join("0123456789abcdef"[d.below(16)] for _ in value)
    return d.like(value)


def written_as(mention: str, value: str) -> str:
    """A surrogate value in the layout of a mention: digits in its groups, its case."""
    digits = [c for c in value if c.isdigit()]
    if set(mention) <= set("0123456789 +()-") and len(digits) == sum(c.isdigit() for c in mention):
        rest = iter(digits)
        return "".join(next(rest) if c.isdigit() else c for c in mention)
    if mention.isupper() and any(c.islower() for c in value):
        return value.upper()
    if mention.islower() and value[:1].isupper():
        return value.lower()
    return value


_MENTIONS = pa.schema([("_row", pa.int64()), ("text", pa.string()), ("start", pa.list_(pa.int32())), ("end", pa.list_(pa.int32())), ("kind", pa.list_(pa.string())), ("value", pa.list_(pa.string()))])


def _with_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if found := find(text):
                start, end, kind, value = map(list, zip(*found, strict=True))
                rows.append({"_row": row, "text": text, "start": start, "end": end, "kind": kind, "value": value})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _MENTIONS)


def _without_entities(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [i for i, text in enumerate(batch.column(text_col).to_pylist()) if not find(text or "")]
            yield batch.take(pa.array(keep, pa.int64()))

    return run


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("kind", "value", "attempt")]
            new = [surrogate(key, k, v, a) for k, v, a in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "value", "n", "attempt")), pa.array(new, pa.string())], names=["kind", "value", "n", "attempt", "surrogate"])

    return run


def _replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts, counts = [], [], []
        for row, text, edits in zip(*(batch.column(c).to_pylist() for c in ("_row", "text", "edits")), strict=True):
            out, at = [], 0
            for e in sorted(edits, key=lambda x: x["start"]):
                out += [text[at : e["start"]], written_as(text[e["start"] : e["end"]], e["surrogate"])]
                at = e["end"]
            rows.append(row)
            texts.append("".join(out) + text[at:])
            counts.append(len(edits))
        yield pa.RecordBatch.from_pydict({"_row": pa.array(rows, pa.int64()), "text": pa.array(texts, pa.string()), "n_entities": pa.array(counts, pa.int64())})


def surrogate_table(entities: DataFrame, key: bytes, rounds: int = ROUNDS) -> DataFrame:
    """(kind, value, n, surrogate) for distinct entities (kind, value, n): no two of a kind share a surrogate, and
    none is itself a value of that kind in the corpus, given names apart, whose cycle excludes collisions.

    Clashing entities draw again (of those that share one all but the first); every check is a grouping and a
    join over the distinct entities.
    """
    ddl = "kind string, value string, n long, attempt int, surrogate string"
    now = checkpointed(entities.withColumn("attempt", F.lit(0)).mapInArrow(_drawn(key), ddl))
    taken = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("_real"))
    for _ in range(rounds):
        first = now.groupBy("kind", "surrogate").agg(F.min("value").alias("_first"))
        seen = now.join(first, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        clash = (F.col("value") != F.col("_first")) | (F.col("_real") & ~F.col("kind").startswith("given"))
        seen = checkpointed(seen.withColumn("_clash", F.coalesce(clash, F.lit(False))))
        again = seen.filter("_clash")
        if again.isEmpty():
            return now.drop("attempt")
        good = seen.filter("NOT _clash").select("kind", "value", "n", "attempt", "surrogate")
        redrawn = again.select("kind", "value", "n", (F.col("attempt") + 1).alias("attempt")).mapInArrow(_drawn(key), ddl)
        now = checkpointed(good.unionByName(redrawn))
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def with_surrogates(docs: DataFrame, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """``docs`` with its text replaced, and _entities, the number of mentions replaced.

    The same entity has the same surrogate in every document (coreference), different entities of a kind
    have different ones (distinctness), and only ``key`` ties them together. Surrogates keep the kind, the
    layout and case of each mention, the validity of card numbers, and for names gender and script. Null
    texts stay null; texts without entities stay as they are; repeated rows are replaced alike; an empty table
    gives none; all other columns are kept (one called
    _entities is replaced). A very long text is searched whole.

    Scale: texts without entities don't move. Those with some are written with their mentions; the distinct
    entities are drawn and checked as a table, and mentions meet their surrogate through ``attach``, so an
    entity that very many documents mention is no group in a task.
    """
    docs = docs.drop("_entities")
    numbered = whole_rows(docs)
    texts = numbered.select("_row", F.coalesce(F.col("_doc")[text_col], F.lit("")).alias("text"))
    found = written(texts.mapInArrow(_with_entities, "_row long, text string, start array<int>, end array<int>, kind array<string>, value array<string>"), "pii-mentions")
    mentions = found.select("_row", F.explode(F.arrays_zip("start", "end", "kind", "value")).alias("e")).select("_row", "e.*")
    entities = checkpointed(mentions.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")))
    total = entities.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    known = surrogate_table(entities, key)
    edits = attach(mentions, known, ["kind", "value"], "n", total)
    edits = edits.groupBy("_row").agg(F.collect_list(F.struct("start", "end", "surrogate")).alias("edits"))  # as many as a text holds
    changed = found.select("_row", "text").join(edits, "_row").mapInArrow(_replaced, "_row long, text string, n_entities long")
    kept = docs.mapInArrow(_without_entities(text_col), docs.schema).withColumn("_entities", F.lit(0).cast("long"))
    new = numbered.join(changed, "_row").select(
        *[(F.col("text") if c == text_col else F.col("_doc")[c]).alias(c) for c in docs.columns], F.col("n_entities").alias("_entities")
    )
    return kept.unionByName(new)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_entities").alias("n_entities"), "text")
