"""Personal data replaced by keyed surrogates of the same kind.

Detected are e-mail addresses, phone, card and social security numbers, IBANs, IPv4 and IPv6 addresses, secrets (keys,
tokens, bearer tokens, passwords in URLs, long hexadecimal strings) and names after an honorific. Each entity is reduced to a canonical value (digits only, lower
case, ...); equal values get equal surrogates everywhere, whatever their spelling, so coreference survives. A surrogate
is drawn from HMAC-SHA-256 of key, kind, value and attempt:

* digits stay digits and letters stay letters of their case; separators, prefixes such as country codes, card issuers
  and top-level domains stay; a valid Luhn or IBAN check stays valid; private and public addresses stay what they are;
* names follow the honorific's gender and the script of the name, part by part, so that "Mrs. Ann Lee" and "Mrs. Lee"
  share a surname.

**Collision checks.** Over the distinct entities of the whole corpus, a surrogate that another entity of its kind has
already, or that is itself a value found in the corpus, is drawn again. Every fourth attempt widens the space to draw
from, so that a full one never stops the job: names, mail addresses, numbers and secrets grow longer; a private address
becomes one of 10.0.0.0/8, then of 100.64.0.0/10, then a unique local IPv6 address, a public one in the end an IPv6 address
of the range for documentation. Checks are joins and aggregates of entities; texts are read once, and rewritten only if
they hold an entity. Values with more than a thousandth of all entities are dealt over slices for the join with their
surrogates; there are less than a thousand of them.

Defined cases: null and empty texts stay as they are; repeated rows stay repeated and get equal texts; texts without
entities are returned byte for byte; an empty table gives an empty result; input columns named like a result give way.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.llm.text_arrays import numbered
from lotbook.sources.scratch import save, save_counted

HOT_SHARE = 1000
HOT_LEAST = 1000
_MALE = r"Mr|Herrn?|Monsieur|Señor|Sr|господин[ау]?|г-н"
_FEMALE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|госпож[аеу]|г-жа"
_PART = r"[A-ZÀ-ÖØ-ÞĀ-ŽА-ЯЁ][a-zß-öø-ÿā-žа-яё'’-]+"
#: Only texts in which this is found are searched for entities; whatever PATTERN finds holds one of these.
HINT = (r"[0-9@]|\b(?:Mr|Herrn?|Monsieur|Señor|Sr|Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Sra|Srta)\b"
        r"|Señor|господин|госпож|г-н|г-жа"
        r"|(?i:api[_-]?key|access[_-]?key|secret|token|password|passwd|pwd|bearer)"
        r"|AKIA|gh[pousr]_|sk-|[A-Fa-f]{32}")
_HOST = r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}"
#: Entities have no upper bound but that of their format. Each run of characters is scanned from its start only, where an
#: address may be of any length; "mail" is one that goes on right behind another entity, within the 64 of a local part.
PATTERN = re.compile(
    r"(?P<secret>(?:(?i:\b(?:api[_-]?key|access[_-]?key|secret|token|password|passwd|pwd))[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
    rf"(?![A-Za-z0-9._%+\-]++{_HOST})"  # an address behind a keyword is replaced as one
    r"(?P<value>(?=[+/_.\-]*+[A-Za-z0-9])[A-Za-z0-9+/_\-][A-Za-z0-9+/_.\-]{10,}[A-Za-z0-9+/_\-]={0,2}))"
    r"|(?i:\bbearer)\s{1,3}(?P<bearer>(?=[A-Za-z+/_.\-]*+[0-9])[A-Za-z0-9+/_\-][A-Za-z0-9+/_.\-]{14,}[A-Za-z0-9+/_\-]={0,2})"
    r"|(?<=://)[^\s/:@?#]++:(?P<login>[^\s/@?#]++)(?=@)"
    rf"|(?<![A-Za-z0-9._%+\-])[._%+\-]*+(?P<email>[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9_+\-])?{_HOST})"
    rf"|(?P<mail>(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+\-]{{0,62}}[A-Za-z0-9_+\-])?{_HOST})"
    r"|(?P<bare>(?<![A-Za-z0-9])(?:(?=[0-9]*+[A-Fa-f])[0-9A-Fa-f]{32,}+"
    r"|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}+|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: ?[0-9]{4}){2,7}(?: ?[0-9]{1,3})?|[A-Z]{4}[0-9]{6,22})(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![A-Za-z0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9]))"
    r"|(?P<ip6>(?<![A-Za-z0-9:.])(?=[A-Fa-f:]*+[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![A-Za-z0-9:]))"
    r"|(?P<ssn>(?<![A-Za-z0-9+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<phone>(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}"
    r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9]))"
    r"|(?P<card>(?<![A-Za-z0-9+])(?:[0-9][ -]?){12,18}[0-9](?![0-9]))"
    rf"|\b(?:(?P<male>{_MALE})|(?P<female>{_FEMALE}))\b\.? (?P<name>{_PART}(?: {_PART})*+)"
)


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of each entity; a name gives one for each part."""
    for found in PATTERN.finditer(text):
        kind = found.lastgroup
        if found["name"]:
            sex = "m" if found["male"] else "f"
            parts = list(re.finditer(r"\S+", found["name"]))
            for part in parts:
                role = "surname" if part is parts[-1] else f"given_{sex}"
                start = found.start("name") + part.start()
                yield start, start + len(part[0]), role, part[0].lower()
            continue
        if found["secret"]:
            kind, (start, end) = "secret", found.span("value")
        elif own := next((k for k in ("bare", "bearer", "login") if found[k]), None):
            kind, (start, end) = "secret", found.span(own)
        elif found["mail"]:
            kind, (start, end) = "email", found.span("mail")
        else:
            kind = next(k for k in ("email", "iban", "ip", "ip6", "ssn", "phone", "card") if found[k])
            start, end = found.span(kind)
        shown = text[start:end]
        yield start, end, kind, canonical(kind, shown)


def canonical(kind: str, shown: str) -> str:
    if kind in ("email", "ip6") or kind == "secret" and re.fullmatch(r"[0-9A-Fa-f]+", shown):
        return shown.lower()
    if kind in ("iban", "ssn", "phone", "card"):
        return re.sub(r"[^0-9A-Z+]", "", shown)
    return shown


class Draw:
    """An endless keyed stream of bounded numbers."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.block, self.pool = key, "\0".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        while len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        head, self.pool = self.pool[:4], self.pool[4:]
        return int.from_bytes(head, "big") % n

    def like(self, shown: str) -> str:
        """Each digit or ASCII letter replaced by one of its class; a leading digit other than 0 stays so."""
        out = []
        for i, c in enumerate(shown):
            if c.isascii() and c.isdigit():
                out.append(str(self.below(9) + 1 if i == 0 and c != "0" else self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def _luhn(digits: str) -> int:
    doubled = (int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


# Syllables of made-up names: onsets, vowels, and endings that read as male or female in the script.
_LATIN = ("b d f g k l m n p r s t v br dr gr kl st tr".split(), "a e i o u".split(), "n r s l k t".split(), "a")
_CYRILLIC = ("б в г д к л м н п р с т бр др гр кл ст тр".split(), "а е и о у".split(), "н р с л к т".split(), "а")


def _made_name(draw: Draw, kind: str, value: str, longer: int) -> str:
    onsets, vowels, ends, female = _CYRILLIC if re.search("[а-яё]", value) else _LATIN
    name = ""
    for _ in range(max(2, min(5, len(value) // 3)) + longer):
        name += onsets[draw.below(len(onsets))] + vowels[draw.below(len(vowels))]
    name = name[:-1] + female if kind == "given_f" else name + ends[draw.below(len(ends))]
    return name


def surrogate(kind: str, value: str, key: bytes, attempt: int) -> str:
    """The canonical surrogate of a canonical value."""
    draw, wider = Draw(key, kind, value, str(attempt)), attempt // 4
    if kind == "email":
        local, _, domain = value.partition("@")
        labels, top = domain.rsplit(".", 1)
        local = draw.like(local) + "".join(chr(97 + draw.below(26)) for _ in range(wider))
        # The domain depends on itself only: addresses of one house stay together.
        return f"{local}@{Draw(key, 'domain', labels, str(attempt // 16)).like(labels)}.{top}"
    if kind == "ip":
        return _address(draw, *map(int, value.split(".")[:2]), wider)
    if kind == "ip6":
        head, _, rest = value.partition(":")
        if wider:
            return ":".join([head, *["%x" % draw.below(1 << 16) for _ in range(7)]])
        return f"{head}:" + "".join(c if c == ":" else "%x" % draw.below(16) for c in rest)
    if kind == "card":
        body = value[0] + draw.like("0" + value[1:] + "0" * wider)[1:]
        if _luhn(value):
            return body
        rest = _luhn(body[:-1] + "0")
        return body[:-1] + str((10 - rest) % 10)
    if kind == "phone":
        keep = 2 if value.startswith("+") else 0
        return value[:keep] + draw.like(value[keep:] + "0" * wider)
    if kind == "iban":
        body = value[:2] + "00" + draw.like("A" + value[4:] + "0" * wider)[1:]
        if _iban_rest(value) != 1:
            return value[:2] + draw.like("0" + value[2:4])[1:] + body[4:]
        return f"{value[:2]}{98 - _iban_rest(body):02d}{body[4:]}"
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", value):
            return "".join("0123456789abcdef"[draw.below(16)] for _ in value + "0" * wider)
        head = re.match(r"AKIA|gh[pousr]_|sk-|", value)[0]
        return head + draw.like("." + value[len(head):] + "a" * wider)[1:]
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}" + draw.like("." + "0" * wider)[1:]
    return _made_name(draw, kind, value, wider)


def _address(draw: Draw, a: int, b: int, wider: int) -> str:
    """An IPv4 address of the kind of ``a.b``, or one of a wider range."""
    private = a in (10, 127) or (a, b) == (192, 168) or a == 172 and 16 <= b < 32
    if wider >= 3:
        head = [0xFD00 + draw.below(256)] if private else [0x2001, 0xDB8]
        return ":".join("%x" % x for x in [*head, *[draw.below(1 << 16) for _ in range(8 - len(head))]])
    if not private:
        free = [x for x in range(1, 224) if x not in (10, 127, 172, 192)]
        a, b = free[draw.below(len(free))], draw.below(256)
    elif wider == 2:
        a, b = 100, 64 + draw.below(64)
    elif wider == 1 or a in (10, 127):
        a, b = 10 if wider else a, draw.below(256)
    elif a == 172:
        b = 16 + draw.below(16)
    return f"{a}.{b}.{draw.below(256)}.{1 + draw.below(254)}"


def shown_like(kind: str, original: str, replacement: str) -> str:
    """The canonical replacement in the spelling of the original: its separators and capitals."""
    if kind in ("ip", "ip6"):
        return replacement.upper() if original.isupper() else replacement
    if kind.startswith(("given", "surname")):
        return replacement.upper() if original.isupper() else replacement.capitalize()
    if kind in ("iban", "ssn", "phone", "card"):
        rest = iter(replacement)
        return "".join(next(rest) if re.match(r"[0-9A-Z+]", c) else c for c in original) + "".join(rest)
    if canonical(kind, original) == original:
        return replacement
    if original.isupper():
        return replacement.upper()
    longer = len(replacement) - len(original)
    at = original.find("@") if longer > 0 and kind == "email" else len(original)
    padded = original[:at] + original[max(at - 1, 0):at] * longer + original[at:]
    return "".join(r.upper() if o.isupper() else r for o, r in zip(padded, replacement, strict=True))


_PIECE = T.StructType([
    T.StructField("lead", T.StringType()), T.StructField("shown", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("value", T.StringType()),
])
_PIECE_ARROW = pa.struct([(f.name, pa.string()) for f in _PIECE.fields])


def _cut(text: str) -> list[dict]:
    """The text in front of each entity with the entity, then what follows the last; empty without entities."""
    pieces, done = [], 0
    for start, end, kind, value in entities(text):
        pieces.append({"lead": text[done:start], "shown": text[start:end], "kind": kind, "value": value})
        done = end
    return [*pieces, {"lead": text[done:], "shown": "", "kind": "", "value": ""}] if pieces else []


def _found(rows: DataFrame, text: str) -> DataFrame:
    """The rows with the ``pieces`` of their column ``text``."""
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("pieces", T.ArrayType(_PIECE))])

    def run(batches):
        for batch in batches:
            texts = batch.column(text)
            hints = pc.fill_null(pc.match_substring_regex(texts, HINT), False).to_pylist()
            pieces = [_cut(texts[i].as_py()) if hint else [] for i, hint in enumerate(hints)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pieces, pa.list_(_PIECE_ARROW))], names=[*names, "pieces"])

    return rows.mapInArrow(run, schema)


def _drawn(values: DataFrame, key: bytes, attempt: int) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "value", "surrogate")])

    def run(batches):
        for batch in batches:
            kinds, originals = batch.column("kind").to_pylist(), batch.column("value").to_pylist()
            made = [surrogate(k, v, key, attempt) for k, v in zip(kinds, originals, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("value"), pa.array(made, pa.string())],
                                             names=["kind", "value", "surrogate"])

    return values.select("kind", "value").mapInArrow(run, schema)


def distinct_surrogates(values: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, surrogate`` for distinct entities: distinct within a kind and unlike any value found."""
    values, n_open = save_counted(values, "entities")
    settled, waiting, attempt = None, values, 0
    while n_open:
        drawn = save(_drawn(waiting, key, attempt), "drawn")
        free = drawn.join(values.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        # Of those that drew the same, the smallest value keeps it.
        good = save(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
                    .select("kind", "value", "surrogate"), "surrogates")
        settled = good if settled is None else settled.unionByName(good)
        waiting, n_open = save_counted(drawn.join(good, ["kind", "value"], "left_anti").select("kind", "value"),
                                       "entities")
        attempt += 1
    return settled if settled is not None else values.withColumn("surrogate", F.lit(None).cast("string"))


@F.pandas_udf(T.StringType())
def _shown(kind, original, replacement):
    import pandas as pd

    return pd.Series([shown_like(k, o, r) if r is not None else "" for k, o, r in
                      zip(kind, original, replacement, strict=True)])


def replace_personal_data(
    docs: DataFrame, key: str, text_col: str = "text", *, count_col: str = "n_surrogates",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """All rows with surrogates in ``text_col`` and the number of entities replaced in ``count_col`` (long)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != count_col.lower()]
    place = next(i for i, c in enumerate(keep) if c.lower() == text_col.lower())
    # Columns of the input go by their places, so that none of them clashes with those of a step.
    rows = docs.select(*numbered(keep))
    own, source = rows.columns, f"k{place}"
    rows = rows.withColumn(source, F.col(source).cast("string"))
    found = save(_found(rows, source).withColumn("row", F.monotonically_increasing_id()), "found")
    clean = found.filter(F.size("pieces") == 0).select(*own, F.lit(0).cast("long").alias("n"))
    dirty = found.filter(F.size("pieces") > 0)
    # Only the entities go to the join with their surrogates; the text between them stays with its row.
    marks = dirty.select("row", F.posexplode("pieces").alias("place", "piece")).select(
        "row", "place", "piece.kind", "piece.value", "piece.shown").filter("kind <> ''")
    counted = save(marks.groupBy("kind", "value").agg(F.count("*").alias("n")), "values")
    made = distinct_surrogates(counted.select("kind", "value"), key.encode())
    placed = _joined(marks, made, counted).select(
        "row", F.struct("place", _shown("kind", "shown", "surrogate").alias("new")).alias("new"))
    news = placed.groupBy("row").agg(F.array_sort(F.collect_list("new")).alias("news"))
    text = F.array_join(F.transform("pieces", lambda piece, i: F.concat(
        piece["lead"], F.coalesce(F.get("news", i)["new"], F.lit("")))), "")
    changed = dirty.join(news, "row").select(
        *[text.alias(c) if c == source else F.col(c) for c in own], F.size("news").cast("long").alias("n"))
    return clean.unionByName(changed).toDF(*keep, count_col)


def _joined(marks: DataFrame, made: DataFrame, counted: DataFrame) -> DataFrame:
    """Marks with their surrogates; values of many marks are dealt over slices."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_SHARE + 1)
    # Less than HOT_SHARE values hold more than the limit.
    hot = F.broadcast(counted.filter(F.col("n") > limit).select(
        "kind", "value", F.ceil(F.col("n") / limit).cast("int").alias("slices")))
    one = F.coalesce("slices", F.lit(1))
    dealt = marks.join(hot, ["kind", "value"], "left").withColumn("slice", F.pmod(F.xxhash64("row"), one).cast("int"))
    copies = made.join(hot, ["kind", "value"], "left").select(
        "kind", "value", "surrogate", F.explode(F.sequence(F.lit(0), one - 1)).alias("slice"))
    return dealt.drop("slices").join(copies, ["kind", "value", "slice"])
