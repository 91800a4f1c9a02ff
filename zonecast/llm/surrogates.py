"""Personal data: detected entities are replaced by keyed surrogates of the same type, script and format.

1. Detection: patterns for addresses, numbers and secrets, and names after a form of address, which tells their gender; a full name found
   so is also found without it in the same text. Family names may have particles, hyphens and apostrophes. A mention's canonical form
   (digits only; lower case for addresses, as it is for secrets) is what makes mentions corefer.
2. Surrogates are drawn from a keyed hash of type and canonical form: digits for digits, letters of the same script and case for letters,
   octets for octets, first names of the same gender. Cards and IBANs keep whether their check digits hold. The
   surrogate is drawn for the canonical form and written in the format of each mention. First and family name are entities of their own, so
   a person keeps one family name with and without the first.
3. Collision checks: the distinct entities of the corpus are grouped by surrogate. Where several share one, or one equals a real
   entity of its type, all but the first draw again, until no collision is left; from attempt ``KEEP_FORM`` on surrogates are longer
   than their form, as its space may be exhausted. A secret has a letter or digit. Distinct entities so stay distinct everywhere, and one entity
   has one surrogate everywhere.
   Names are told apart by script and canonical form alone, whatever their form of address; a stated gender wins over that of 'Dr', and a
   first name met with both genders gets one that fits either.
4. Only entities that had to draw again, and first names met with several genders, are sent to their documents; the planner decides by the written table's size whether by
   broadcast or by a join on ``doc_id``.

Texts without any such mention pass unchanged. Null text stays null. Null and repeated ids and repeated rows change nothing, as
entities and not rows decide. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.tables import kind
from zonecast.session import materialize

#: Forms of address by gender, and names to draw from by gender and script.
ADDRESS = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Госпожа"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин"],
    "n": ["Dr", "Prof"],
}
FIRST = {
    ("f", "LATIN"): ["Anna", "Clara", "Elena", "Greta", "Irene", "Julia", "Laura", "Marta", "Nora", "Paula", "Rosa", "Sara", "Teresa", "Vera"],
    ("m", "LATIN"): ["Adam", "Bruno", "Carlos", "Daniel", "Erik", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Victor"],
    ("n", "LATIN"): ["Alex", "Andrea", "Chris", "Dana", "Jean", "Kim", "Luca", "Noa", "Robin", "Sam", "Toni"],
    ("f", "CYRILLIC"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("m", "CYRILLIC"): ["Андрей", "Борис", "Иван", "Николай", "Олег", "Павел", "Сергей"],
    ("n", "CYRILLIC"): ["Саша", "Женя", "Валя"],
}
LAST = {
    "LATIN": ["Abel", "Bauer", "Costa", "Duval", "Ebert", "Ferrer", "Garnier", "Hansen", "Ibarra", "Keller", "Lopez", "Moreau", "Novak", "Olsen", "Perez", "Roth", "Silva", "Weber"],
    "CYRILLIC": ["Белов", "Громов", "Зайцев", "Козлов", "Морозов", "Орлов", "Соколов"],
}

_TITLES = "|".join(re.escape(t) for group in ADDRESS.values() for t in group)
_GENDER = {t: g for g, group in ADDRESS.items() for t in group}
_WORD = r"(?:[^\W\d_a-zа-яß-öø-ÿ]['’])?[^\W\d_a-zа-яß-öø-ÿ][^\W\d_]+"
_NAME = rf"{_WORD}(?:[-'’]{_WORD})*"
#: Words that may stand before a family name.
PARTICLES = ["de", "del", "della", "der", "den", "di", "da", "dos", "du", "la", "las", "le", "los", "ter", "van", "von", "zu"]
_FAMILY = rf"(?:(?:{'|'.join(PARTICLES)}) )*{_NAME}"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])\w[\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|\b(?i:tokens?|secret|password|passwd|api[_-]?key)\b\s*[=:]\s*(?:(?P<q>[\"'])(?P<quoted>(?=[^\s\"']*[^\W_])[^\s\"']{6,})(?P=q)|[\"']?(?P<secret>(?=[^\s\"'#$%&*!<>|]*[^\W_])[^\s\"'#$%&*!<>|]{8,}|(?=[^\s\"'#$%&*!<>|]*\d)[A-Za-z0-9]{6,7}(?!\S)))"
    r"|\b(?:Bearer\s+)(?P<bearer>[A-Za-z0-9._~+/-]{16,}=*)"
    r"|\b(?P<access>AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9_-]{20,})(?![0-9A-Za-z])"
    r"|(?P<ipv6>(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:]))"
    r"|(?P<hex>(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z]))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z]))"
    r"|(?P<phone>(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[-.]\d{3}[-.]\d{4}(?![\d-])|(?<![\d/])0\d{2,4}/\d{5,8}(?![\d/]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d))"
    rf"|\b(?P<title>{_TITLES})\.? (?P<name>(?:{_NAME} )?{_FAMILY})"
)
_GROUPS = ["email", "secret", "quoted", "bearer", "access", "ipv6", "hex", "ip", "iban", "phone", "ssn", "card"]
#: Every mention has a digit, an at sign, a form of address or one of these words.
_SPOT = re.compile(r"@|\d+")
_KEYS = ["secret", "passw", "token", "key", "bearer", "akia", "sk-"]
_HINT = re.compile(rf"(?i:{'|'.join(_KEYS)}|[0-9a-f]:[0-9a-f]+:)|\b(?:{_TITLES})\b")
#: Characters looked at on either side of such a spot, on to the next white space.
_REACH = 64
_SPACE = re.compile(r"\s")
#: Attempts within the form of the mention; later ones widen it, so the supply never ends.
KEEP_FORM = 8
TYPES = ["email", "secret", "hex", "ip", "iban", "phone", "ssn", "card", "name"]


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """The parts of a text that can hold a mention."""
    spots = [m.span() for m in _SPOT.finditer(text)]
    low = text.lower()
    if any(h in low for h in _KEYS) or any(t in text for t in _GENDER) or low.count(":") >= 7:
        spots = sorted(spots + [m.span() for m in _HINT.finditer(text)])
    begin = end = -1
    for a, b in spots:
        if a >= end:
            if end >= 0:
                yield begin, end
            begin = max(a - _REACH, max(end, 0))
            while begin > max(end, 0) and not text[begin - 1].isspace():
                begin -= 1
        found = _SPACE.search(text, b + _REACH)
        end = found.start() if found else len(text)
    if end >= 0:
        yield begin, end


#: Types of the groups of the pattern that are not named after theirs.
_TYPE_OF = {"hex": "secret", "quoted": "secret", "bearer": "secret", "access": "secret"}


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, mention) in order; the type of a name carries its gender and script."""
    found = []
    for begin, end in _windows(text):
        for m in PATTERN.finditer(text, begin, end):
            group = next(g for g in (*_GROUPS, "name") if m[g])
            kind_ = f"name:{_GENDER[m['title']]}:{script(m['name'][0])}" if group == "name" else _TYPE_OF.get(group, group)
            found.append((m.start(group), m.end(group), kind_, m[group]))
    known = {m: k for _, _, k, m in found if k.startswith("name:") and split(m)[0]}
    if known:
        taken = sorted(found)
        # The same full name without a form of address.
        bare = re.compile(rf"(?<![\w-])(?:{'|'.join(map(re.escape, sorted(known, key=len, reverse=True)))})(?![\w-])")
        at = 0
        for m in bare.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at == len(taken) or taken[at][0] >= m.end():
                found.append((m.start(), m.end(), known[m[0]], m[0]))
        found.sort()
    yield from found


def split(name: str) -> tuple[str, str]:
    """First name (or nothing) and family name with its particles."""
    first, _, rest = name.partition(" ")
    return (first, rest) if rest and first not in PARTICLES else ("", name)


def entities_of(kind_: str, mention: str) -> list[tuple[str, str, str]]:
    """(type, gender, canonical form) of the entities of a mention: two of a full name, whose first name has the gender."""
    if not kind_.startswith("name:"):
        return [(kind_, "", canonical(kind_, mention))]
    _, gender, written_ = kind_.split(":")
    first, family = split(mention)
    return [(f"given:{written_}", gender, first)] * bool(first) + [(f"name:{written_}", "", family)]


def canonical(kind_: str, mention: str) -> str:
    if kind_ in ("phone", "ssn", "card"):
        return re.sub(r"\D", "", mention)
    if kind_ == "iban":
        return mention.replace(" ", "")
    return mention.lower() if kind_ in ("email", "ip", "ipv6") else mention


def script(letter: str) -> str:
    name = unicodedata.name(letter, "LATIN").split(" ")[0]
    return name if name in LAST else "LATIN"


def _draws(key: bytes, kind_: str, form: str, attempt: int) -> Iterator[int]:
    """An endless keyed stream of 32-bit numbers."""
    n = 0
    while True:
        block = hmac.new(key, f"{kind_}\0{form}\0{attempt}\0{n}".encode(), hashlib.sha256).digest()
        for i in range(0, 32, 4):
            yield int.from_bytes(block[i : i + 4], "big")
        n += 1


def _letter(c: str, draw: int) -> str:
    """A letter of the same script, case and kind."""
    if "a" <= c <= "z":
        return chr(97 + draw % 26)
    if "A" <= c <= "Z":
        return chr(65 + draw % 26)
    base = ord(c) & ~63
    alike = [chr(x) for x in range(base, base + 64) if unicodedata.category(chr(x)) == unicodedata.category(c) and len(chr(x).lower()) == 1]
    return alike[draw % len(alike)] if alike else c


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_holds(form: str) -> bool:
    """Whether the check number of an IBAN is right."""
    moved = form[4:] + form[:4]
    return moved.isascii() and moved.isalnum() and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def surrogate(key: bytes, kind_: str, form: str, attempt: int = 0, gender: str = "") -> str:
    """The canonical surrogate of a canonical form; a whole name is made of those of its parts."""
    if kind_.count(":") == 2:
        return " ".join(surrogate(key, t, f, attempt, gender or g) for t, g, f in entities_of(kind_, form))
    draws = _draws(key, kind_, form, attempt)
    # A form whose space may be exhausted grows, by one more character every four attempts.
    more = max(attempt - KEEP_FORM + 4, 0) // 4
    if kind_.startswith(("name:", "given:")):
        part, written_ = kind_.split(":")
        names = LAST[written_] if part == "name" else FIRST[gender or "n", written_]
        # Later attempts draw longer names, so the supply never ends.
        return "-".join(names[next(draws) % len(names)] for _ in range(1 + attempt // 4))
    if kind_ == "ipv6":
        return ":".join("".join("0123456789abcdef"[next(draws) % 16] for _ in range(min(len(g) + more, 4))) for g in form.split(":"))
    if kind_ == "ip":
        # Wider octets first, then more of them.
        sizes = [min(len(o) + more, 3) for o in form.split(".")] + [3] * max(more - 2, 0)
        return ".".join(str(1 + d % 9 if n == 1 else 10 + d % 90 if n == 2 else 100 + d % 155) for n, d in zip(sizes, draws))
    if kind_ == "card":
        body = form[0] + "".join(str(next(draws) % 10) for _ in range(len(form) - 2 + more))
        valid = next(str(c) for c in range(10) if luhn(body + str(c)))
        return body + (valid if luhn(form) else str((int(valid) + 1 + next(draws) % 9) % 10))
    if kind_ == "phone" and len(form) == 11 and form[0] == "1":
        return "1" + _plain(form[1:] + "0" * more, draws)  # the country stays
    if kind_ == "iban":
        body = "".join(str(next(draws) % 10) if c.isdigit() else _letter(c, next(draws)) for c in form[4:] + "0" * more)
        check = next(c for c in range(2, 99) if iban_holds(f"{form[:2]}{c:02d}{body}"))
        return f"{form[:2]}{check if iban_holds(form) else (check + 1 + next(draws) % 95) % 100:02d}{body}"
    if kind_ == "email":
        local, _, domain = form.partition("@")
        host, _, top = domain.rpartition(".")
        return _plain(local + "a" * more, draws) + "@" + _plain(host, draws) + "." + top
    if kind_ == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", form):
        made = "".join("0123456789abcdef"[next(draws) % 16] for _ in range(len(form) + more))
        return made.upper() if form.isupper() else made
    if kind_ == "secret":
        # What tells the kind of a key stays.
        kept = next((p for p in ("AKIA", "sk-") if form.startswith(p)), "")
        return kept + _plain(form[len(kept) :] + "a" * more, draws)
    return _plain(form + ("0" if form.isdigit() else "a") * more, draws)


def _plain(form: str, draws: Iterator[int]) -> str:
    return "".join(str(next(draws) % 10) if c.isdigit() else _letter(c, next(draws)) if c.isalpha() else c for c in form)


def written(kind_: str, mention: str, made: str) -> str:
    """The canonical surrogate in the format of a mention."""
    if kind_ in ("phone", "ssn", "card"):
        digits = iter(made)
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if kind_ == "iban":
        chars = iter(made)
        return "".join(c if c == " " else next(chars) for c in mention) + "".join(chars)
    if kind_ != "secret" and mention.isupper() and not made.isupper():
        return made.upper()
    return made


def _found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, seen = [], {}
        column = batch.schema.get_field_index("text")
        for i, text in enumerate(batch.column(column).to_pylist()):
            for _, _, k, mention in mentions(text or ""):
                for one in entities_of(k, mention):
                    seen[i, *one] = None
        rows = list(seen)
        ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array([r[0] for r in rows], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())], ["doc_id", "type", "gender", "form"])


def _drawn(key: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            made = [surrogate(key, r["type"], r["form"], r["attempt"], r["gender"]) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, "made"])

    return run


def settled(found: DataFrame) -> DataFrame:
    """(type, form, gender, several) of each entity: a stated gender wins over 'n', and where both are stated 'n' is left."""
    stated = F.collect_set(F.when(F.col("gender") != "n", F.col("gender")))
    gender = F.when(F.size("stated") == 1, F.col("stated")[0]).otherwise("n")
    each = found.groupBy("type", "form").agg(stated.alias("stated"), (F.min("gender") != F.max("gender")).alias("several"))
    return each.select("type", "form", gender.alias("gender"), "several")


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """(type, form, gender, attempt) of each entity; ``entities`` has each (type, form) once."""
    spark = entities.sparkSession
    schema = "type string, form string, gender string, attempt int, made string"
    drawn = materialize(entities.select("type", "form", "gender", F.lit(0).alias("attempt")).mapInArrow(_drawn(key), schema), "surrogates")
    while True:
        first = drawn.groupBy("type", "made").agg(F.min(F.struct("attempt", "form")).alias("first"), F.count(F.lit(1)).alias("n"))
        shared = drawn.join(first.where("n > 1"), ["type", "made"]).where("form != first.form").select("type", "form")
        real = drawn.join(entities.select("type", F.col("form").alias("made")).distinct(), ["type", "made"], "left_semi").select("type", "form")
        again = materialize(shared.unionByName(real).distinct(), "collisions")
        if again.isEmpty():
            break
        redrawn = drawn.join(again, ["type", "form"], "left_semi").select("type", "form", "gender", (F.col("attempt") + 1).alias("attempt"))
        kept = drawn.join(again, ["type", "form"], "left_anti")
        drawn = materialize(kept.unionByName(redrawn.mapInArrow(_drawn(key), schema)), "surrogates")
    return drawn.select("type", "form", "gender", "attempt")


def _replaced(key: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.schema.get_field_index("text")
            texts, counts = [], []
            again = batch.column(batch.schema.get_field_index("_zc_again")).to_pylist()
            for text, more in zip(batch.column(column).to_pylist(), again):
                drawn = {(m["type"], m["form"]): (m["attempt"], m["gender"]) for m in more or []}
                out, last, n = [], 0, 0
                for start, end, k, mention in mentions(text or ""):
                    made = " ".join(surrogate(key, t, f, *drawn.get((t, f), (0, g))) for t, g, f in entities_of(k, mention))
                    out += [text[last:start], written(k, mention, made)]
                    last, n = end, n + 1
                texts.append("".join(out) + text[last:] if n else text)
                counts.append(n)
            rest = [i for i, name in enumerate(batch.schema.names) if name not in ("text", "_zc_again")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                [*(batch.schema.names[i] for i in rest), "text", "n_replaced"],
            )

    return run


def replace_personal_data(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates and n_replaced of each document."""
    schema = f"doc_id {kind(docs, 'doc_id')}, type string, gender string, form string"
    found = materialize(docs.select("doc_id", "text").mapInArrow(_found, schema), "mentions")
    entities = materialize(settled(found), "entities")
    again = assigned(entities, key).join(entities.select("type", "form", "several"), ["type", "form"])
    again = materialize(again.where("attempt > 0 or several").drop("several"), "again")
    rows = found.select("doc_id", "type", "form").join(again, ["type", "form"]).groupBy(F.col("doc_id").alias("_zc_of"))
    rows = rows.agg(F.collect_set(F.struct("type", "form", "attempt", "gender")).alias("_zc_again"))
    rows = materialize(rows, "again")
    joined = docs.select("doc_id", "text").join(rows, docs["doc_id"].eqNullSafe(rows["_zc_of"]), "left").drop("_zc_of")
    return joined.mapInArrow(_replaced(key), f"doc_id {kind(docs, 'doc_id')}, text string, n_replaced long")
