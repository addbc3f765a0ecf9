"""PII surrogates: detected entities are replaced by keyed fakes of the same kind and form.

A surrogate is a function of (key, kind, normalised entity, attempt): an HMAC stream picks its
digits, letters and names. Of all but names it keeps length, separators and letter case; script (Latin, Greek,
Cyrillic or other letters stay in their script's alphabet), the country code of a phone number,
whether a card number has a valid check digit and an IBAN valid check digits, and the gender that a
person's title (or, after a title without one, a known given name) implies. Names keep their capitals
as a whole word does and have a length of their own.
The same entity gets the same surrogate in every document (coreference).

Distinctness is checked over the whole corpus: the distinct entities and their surrogates are
compared with one another and with all real entities; an entity that collides moves on to its
next attempt until none does. The first ``FORMED`` attempts keep the form; each later one is a
character longer (``_wide``), so the choices outgrow the entities of any form and the search ends
however few values a form has. Entities of attempt 0 need no table, so only the moved ones (in
blocks of ``BLOCK`` entries, one block broadcast per pass) are looked up when texts are rewritten.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm.common import cut, pick, prepare, with_last

BLOCK, FORMED = 200_000, 8
#: Titles by the gender they imply, and given names to choose from.
TITLES = {
    "m": "Mr Mister Sir Herr Herrn Monsieur Señor Don Господин г-н Κύριος κ",
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Mlle Señora Señorita Doña Госпожа г-жа Κυρία",
    "n": "Dr Prof Professor Mx"}
GIVEN = {
    ("Latin", "m"): "James Robert David Thomas Daniel Paul Martin Peter Lukas Felix Hugo Louis Carlos Diego Pablo Andrés",
    ("Latin", "f"): "Mary Anna Laura Emma Julia Sarah Clara Sophie Alice Chloé Marie Lucía Elena Carmen Hannah Greta",
    ("Cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Николай Михаил Андрей",
    ("Cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана",
    ("Greek", "m"): "Γιώργος Νίκος Κώστας Δημήτρης Γιάννης Παύλος",
    ("Greek", "f"): "Μαρία Ελένη Κατερίνα Άννα Σοφία Ειρήνη"}
#: Syllables of family names, by script.
SYLLABLES = {"Latin": "ba ber can dor el far gan hal ker lin mar nor pel ras sen tor val wen zel mon",
             "Cyrillic": "ба вер гор дан жел зим кар лов мир нов пет рас сол тур фед чер",
             "Greek": "βα γερ δαν καλ λιν μαρ νικ παπ ρασ σταμ τσικ φωτ"}
#: Endings of family names, masculine and feminine; the real name's last letter tells which.
ENDINGS = {"Latin": ("", ""), "Cyrillic": ("ин", "ина"), "Greek": ("ος", "ου")}
_FEMININE = {"Latin": "", "Cyrillic": "ая", "Greek": "αάηήυού"}

#: Country calling codes of one and two digits (ITU E.164); all others have three.
SHORT_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
_CODE = re.compile(rf"\+(?:{'|'.join(sorted(SHORT_CODES.split(), key=len, reverse=True))}|\d{{1,3}})")

_TITLE_GENDER = {t: g for g, names in TITLES.items() for t in names.split()}
_UPPER = "A-ZÀ-ÖØ-ÞĀ-ŽΑ-ΩΆ-ΏА-ЯЁ"
_NAME = rf"(?:[{_UPPER}]['’])?[{_UPPER}][^\W\d_]+(?:['’-][{_UPPER}][^\W\d_]+)*"
_GIVEN_GENDER = {n.casefold(): g for (_, g), names in GIVEN.items() for n in names.split()}
_KINDS = [
    r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:\.[A-Za-z0-9][A-Za-z0-9-]{0,62})*\.[A-Za-z]{2,24}\b)",
    r"(?P<secret>(?:(?<=[\s\"'(\[{,;|])|(?<![\s\S]))(?i:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|token|passw(?:or)?d|pwd)\"?[ \t]*[:=][ \t]*(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[A-Za-z0-9+/_=.-]{8,}))",
    r"(?P<hex>(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9]))",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
    r"(?P<mac>(?<![\w:.-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\w:-]))",
    r"(?P<ipv6>(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]))",
    r"(?P<ipv4>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))",
    r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
    r"(?P<card>(?<![\d.+-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\d-]))",
    r"(?P<phone>(?<![\w+.(])(?:\+\d{1,3}[^\w\n]{1,6}\(\d{1,4}\)[^\w\n]{1,6}\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|(?:00\d{1,3}[ .-])?\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w]))",
    rf"(?P<person>\b(?:{'|'.join(sorted(map(re.escape, _TITLE_GENDER), key=len, reverse=True))})\.?[  ]{_NAME}(?:[  ]{_NAME}){{0,2}})",
]
_PATTERN = re.compile("|".join(_KINDS))
_PERSON = re.compile(_KINDS[-1])
#: Every kind but persons has one of these; no entity crosses a line end.
_TRIGGER = re.compile(r"[\d@:=]")
_VALUE = re.compile(r"[:=][ \t]*([\"']?)(.+)\1$")


def _script(c: str) -> str:
    name = unicodedata.name(c, "")
    return next((s for s in ("Greek", "Cyrillic") if name.startswith(s.upper())), "Latin")


def _ascii(text: str) -> str:
    """Digits of all scripts as 0-9."""
    return "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def _luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _mod97(text: str) -> int:
    """Of an IBAN's characters, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _matches(text: str):
    """Matches in order; the slow pattern runs over the lines that a trigger marks only."""
    at, m = 0, _TRIGGER.search(text)
    while m:
        begin = text.rfind("\n", at, m.start()) + 1 or at
        end = text.find("\n", m.end())
        end = len(text) if end < 0 else end
        yield from _PERSON.finditer(text, at, begin)
        yield from _PATTERN.finditer(text, begin, end)
        at, m = end, _TRIGGER.search(text, end)
    yield from _PERSON.finditer(text, at)


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normalised entity) of the entities of a text, in order, apart.

    A given name has one gender in a text: that of the titles before it, if one tells, else that of
    a known name; so "Mr James" and "Dr James" are one entity.
    """
    out, families, told = [], {}, {}
    for m in _matches(text):
        kind, (a, b) = m.lastgroup, m.span()
        got = text[a:b]
        if kind == "person":
            title, *names = re.split(r"[  ]", got)
            gender = _TITLE_GENDER[title.rstrip(".")]
            at = a + len(title) + 1
            for i, name in enumerate(names):
                what = "given" if i < len(names) - 1 else "family"
                out.append((at, at + len(name), what, name.casefold()))
                if what == "given" and gender != "n":
                    told.setdefault(name.casefold(), gender)
                if what == "family":
                    families[name] = out[-1]
                at += len(name) + 1
            continue
        if kind == "secret":
            v = _VALUE.search(got)
            a, b = a + v.start(2), a + v.end(2)
            kind, norm = "secret", text[a:b]
            if not any(c.isalnum() for c in norm):      # masked already
                continue
        elif kind == "hex":
            kind, norm = "secret", got
        elif kind == "email":
            a += len(got) - len(got.lstrip("."))
            norm = text[a:b].lower()
            if norm[0] == "@":
                continue
        elif kind == "ipv6":
            try:
                norm = str(ipaddress.ip_address(got))
            except ValueError:
                continue
            if not any(c.isdigit() for c in got.strip(":0")):
                continue
        elif kind in ("ipv4", "mac"):
            norm = got.lower()
        else:
            norm = re.sub(r"[^0-9A-Za-z+]", "", got if got.isascii() else _ascii(got)).upper()
            if kind == "phone" and not 7 <= sum(c.isdigit() for c in norm) <= 15:
                continue
        out.append((a, b, kind, norm))
    out = [(a, b, f"given-{told.get(n) or _GIVEN_GENDER.get(n, 'n')}" if kind == "given" else kind, n) for a, b, kind, n in out]
    if families:        # a family name known from a title is the same person elsewhere in the text
        taken = [(s, e) for s, e, _, _ in out]
        names = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(families, key=len, reverse=True))) + r")(?!\w)")
        spans = iter(sorted(taken))
        now = next(spans, None)
        for m in names.finditer(text):
            while now and now[1] <= m.start():
                now = next(spans, None)
            if not now or m.end() <= now[0]:
                out.append((*m.span(), "family", m.group().casefold()))
        out.sort()
    return out


class _Stream:
    """Numbers from HMAC-SHA256 in counter mode."""

    def __init__(self, key: bytes, *parts: str):
        self.seed = hmac.new(key, "\0".join(parts).encode(), hashlib.sha256).digest()
        self.n, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left += hashlib.sha256(self.seed + self.n.to_bytes(8, "big")).digest()
            self.n += 1
        v, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return v % n


def _letters(text: str, s: _Stream, hexed: bool = False) -> str:
    """Digits by digits, letters by letters of the same case and script; the rest stays."""
    out = []
    for c in text:
        if c.isdecimal():
            out.append(chr(ord(c) - unicodedata.decimal(c) + s.below(10)))
        elif hexed and c in "abcdef":
            out.append("abcdef"[s.below(6)])
        elif hexed and c in "ABCDEF":
            out.append("ABCDEF"[s.below(6)])
        elif c.isalpha():
            alphabet = {"Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя"}.get(
                _script(c), "abcdefghijklmnopqrstuvwxyz")
            if not c.isascii() and _script(c) == "Latin" and "LATIN" not in unicodedata.name(c, ""):
                # other scripts: a neighbour in the same block of 16 code points
                near = [chr((ord(c) & ~15) + i) for i in range(16) if chr((ord(c) & ~15) + i).isalpha()]
                out.append(near[s.below(len(near))])
                continue
            new = alphabet[s.below(len(alphabet))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _wide(key: bytes, kind: str, norm: str, attempt: int) -> str:
    """A surrogate for values whose form has too few others: longer by a character per attempt."""
    s, more = _Stream(key, kind, norm, str(attempt)), attempt - FORMED + 1

    def some(n: int, of: str) -> str:
        return "".join(of[s.below(len(of))] for _ in range(n))

    new = surrogate(key, kind, norm, 0)
    if kind == "email":
        local, _, domain = new.rpartition("@")
        return f"{_letters(local, s)}{some(more, 'abcdefghijklmnopqrstuvwxyz')}@{domain}"
    if kind == "secret":        # also what _letters cannot change
        return some(len(norm) + more, "abcdefghijklmnopqrstuvwxyz0123456789")
    if kind == "ipv4":          # private addresses become 10.x first, then any, then IPv6
        if more <= 8:
            return ".".join(["10" if more <= 4 and re.match(r"10\.|192\.168\.|127\.", norm) else str(1 + s.below(223)),
                             *(str(1 + s.below(254)) for _ in range(3))])
        return "fd" + some(2, "123456789abcdef") + "".join(":" + some(4, "123456789abcdef") for _ in range(7))
    if kind == "ipv6":
        return ":".join(some(4, "123456789abcdef") for _ in range(8))
    if kind == "mac":
        return ":".join(some(2, "123456789abcdef") for _ in range(6 + more))
    if kind == "card":
        new = some(1, "123456789") + some(len(norm) - 2 + more, "0123456789")
        return new + next(d for d in "0123456789" if _luhn(new + d) or not _luhn(norm))
    head = 2 if kind == "iban" or new[0] == "+" else 0
    return new[:head] + _letters(new[head:], s) + some(more, "0123456789")


def surrogate(key: bytes, kind: str, norm: str, attempt: int) -> str:
    """The surrogate's normal form."""
    if attempt >= FORMED and kind != "family" and not kind.startswith("given"):
        return _wide(key, kind, norm, attempt)
    s = _Stream(key, kind, norm, str(attempt))
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        host, _, top = domain.rpartition(".")
        # one domain always becomes the same other domain
        return f"{_letters(local, s)}@{_letters(host, _Stream(key, 'domain', domain))}.{top}"
    if kind == "ipv4":
        private = re.match(r"10\.|192\.168\.|127\.", norm)
        kept = private.group() if private else ""
        rest = norm[len(kept):].count(".") + 1
        new = [str(1 + s.below(223 if not kept and i == 0 else 254)) for i in range(rest)]
        return kept + ".".join(new)
    if kind in ("ipv6", "mac"):
        groups = re.split("([:-])", norm)
        return "".join(g if g in ":-" or not g else "".join("0123456789abcdef"[s.below(15) + 1] for _ in g) for g in groups)
    if kind == "card":
        new = str(1 + s.below(9)) + "".join(str(s.below(10)) for _ in norm[1:-1])
        last = [str((s.below(10) + i) % 10) for i in range(1)][0]
        ends = [d for d in "0123456789" if _luhn(new + d) == _luhn(norm)]
        return new + (ends[s.below(len(ends))] if ends else last)
    if kind == "phone":
        code = _CODE.match(norm)
        head = code.group() if code else ""
        return head + "".join(c if c == "+" else str(s.below(10)) for c in norm[len(head):])
    if kind == "iban":
        body = _letters(norm[4:], s)
        check = f"{98 - _mod97(body + norm[:2] + '00'):02}" if _mod97(norm[4:] + norm[:4]) == 1 else _letters(norm[2:4], s)
        return norm[:2] + check + body
    if kind == "secret":
        return _letters(norm, s, hexed=re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", norm) is not None)
    if kind.startswith("given") or kind == "family":
        script = _script(norm[0])
        if kind.startswith("given") and attempt == 0:
            pools = [kind[-1]] if kind[-1] in "mf" else ["m", "f"]
            names = " ".join(GIVEN[script, g] for g in pools).split()
            return names[s.below(len(names))].casefold()
        parts = SYLLABLES[script].split()
        return "".join(parts[s.below(len(parts))] for _ in range(2 + attempt // 4 + s.below(2))) + (
            ENDINGS[script][norm[-1] in _FEMININE[script]] if kind == "family" else "")
    return "".join(str(s.below(10)) if c.isdigit() else c for c in norm)


def form(kind: str, found: str, norm: str, new: str) -> str:
    """The surrogate in the form of the text it replaces."""
    if kind in ("email", "ipv4", "ipv6", "mac", "secret"):
        return new.upper() if kind == "mac" and found.isupper() else new
    if kind == "family" or kind.startswith("given"):
        return new.upper() if found.isupper() and len(found) > 1 else "-".join(p.capitalize() for p in new.split("-"))
    chars, out = iter(new), []
    for c in found:
        if c.isascii() and c.isalnum() or c == "+":
            c = next(chars)
        elif c.isdecimal():
            c = chr(ord(c) - unicodedata.decimal(c) + int(next(chars)))
        out.append(c)
    return "".join(out) + "".join(chars)


def entities(docs: DataFrame) -> DataFrame:
    """kind, norm of every entity found in ``text`` (distinct in each batch)."""

    def run(batches):
        for batch in batches:
            seen = {(k, n) for t in batch["text"].to_pylist() if t for _, _, k, n in find(t)}
            rows = sorted(seen)
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in rows], pa.string()),
                                              "norm": pa.array([n for _, n in rows], pa.string())})

    return docs.select("text").mapInArrow(run, "kind string, norm string")


def _named(e: DataFrame, key: bytes) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict({
                "kind": batch["kind"], "norm": batch["norm"], "attempt": batch["attempt"],
                "new": pa.array([surrogate(key, r["kind"], r["norm"], r["attempt"]) for r in rows], pa.string())})

    return e.select("kind", "norm", "attempt").mapInArrow(run, "kind string, norm string, attempt int, new string")


def resolve(real: DataFrame, key: bytes) -> DataFrame:
    """kind, norm, attempt, new: distinct surrogates, none of them a real entity of its kind.

    Names of different kinds (given, family) may coincide; given names of few choices move on
    to made-up ones where the corpus has more names than there are choices. Names gain syllables and
    all else gains characters from attempt to attempt, so there is no last attempt.
    """
    state = cut(_named(real.withColumn("attempt", F.lit(0)), key))
    taken = real.select("kind", F.col("norm").alias("new"))
    for _ in itertools.count():
        first = state.groupBy("kind", "new").agg(F.min(F.struct("attempt", "norm")).alias("x"), F.count("*").alias("n"))
        twice = first.where("n > 1").select("kind", "new", (F.col("x.norm")).alias("stays"))
        moved = state.join(twice, ["kind", "new"]).where("norm <> stays").select("kind", "norm").union(
            state.join(taken, ["kind", "new"], "left_semi").select("kind", "norm")).distinct()
        moved = cut(moved)
        if moved.isEmpty():
            return state
        again = state.join(moved, ["kind", "norm"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        state = cut(state.join(moved, ["kind", "norm"], "left_anti").unionByName(_named(again, key)))


def _blocks(moved: DataFrame) -> Iterator[dict[tuple[str, str], int]]:
    """The entities of a later attempt, BLOCK or fewer (about) on the driver at a time."""
    n = moved.count() // BLOCK + 1
    part = F.pmod(F.xxhash64("kind", "norm"), F.lit(n))
    for i in range(n):
        yield {(r.kind, r.norm): r.attempt for r in moved.where(part == i).collect()}


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, text with surrogates, entities (kind, start, end in the new text).

    Null texts stay null; texts without an entity, empty ones too, stay as they are. Repeated rows change alike.
    Very long texts are searched whole, the slow patterns on marked lines only; where two kinds begin at one
    place the first of ``_KINDS`` holds. Of entities that collide the one of the least attempt, then of the
    least normal form, keeps its surrogate.
    Columns other than id and text are not read. The key must be kept secret and be the same in
    all runs whose surrogates have to agree.
    """
    spark = docs.sparkSession
    prepare(spark)
    df = pick(docs, id=id_col, text=text_col)
    real = cut(entities(df).distinct())
    moved = cut(resolve(real, key).where("attempt > 0").select("kind", "norm", "attempt"))
    ident = df.schema["id"]
    found = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                      T.StructField("end", T.LongType())]))
    tries = T.ArrayType(T.IntegerType())
    arrow_found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    for entries, last in with_last(_blocks(moved)):
        block = spark.sparkContext.broadcast(entries)

        def run(batches, block=block, last=last):
            for batch in batches:
                before = batch["tries"].to_pylist() if "tries" in batch.schema.names else None
                texts, marks, tried = [], [], []
                for i, t in enumerate(batch["text"].to_pylist()):
                    spans = find(t) if t else []
                    attempt = [block.value.get((k, v), 0) for _, _, k, v in spans]
                    if before:
                        attempt = [max(x, y) for x, y in zip(attempt, before[i])]
                    tried.append(attempt)
                    if last:
                        new, mark = _rewrite(t, spans, attempt, key)
                        texts.append(new)
                        marks.append(mark)
                if last:
                    yield pa.RecordBatch.from_pydict({"id": batch["id"], "text": pa.array(texts, pa.string()),
                                                      "entities": pa.array(marks, arrow_found)})
                else:
                    yield pa.RecordBatch.from_pydict({"id": batch["id"], "text": batch["text"],
                                                      "tries": pa.array(tried, pa.list_(pa.int32()))})

        df = df.mapInArrow(run, T.StructType([ident, T.StructField("text", T.StringType()),
                                              T.StructField("entities", found) if last else T.StructField("tries", tries)]))
        if not last:        # one block at a time in a worker's memory
            df = cut(df)
            block.destroy()
    return df.withColumnsRenamed({"id": id_col, "text": text_col})


def _rewrite(text, spans, attempts, key):
    if not spans:
        return text, []
    out, marks, at, size = [], [], 0, 0
    for (a, b, kind, norm), attempt in zip(spans, attempts):
        new = form(kind, text[a:b], norm, surrogate(key, kind, norm, attempt))
        out += [text[at:a], new]
        size += a - at + len(new)
        marks.append({"kind": kind, "start": size - len(new), "end": size})
        at = b
    out.append(text[at:])
    return "".join(out), marks
