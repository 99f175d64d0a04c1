"""Personal data: regular expressions propose spans, checksums confirm them,
context words nearby adjust the score. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points on each side of a span that are searched for context words.
CONTEXT = 40
#: Spans of the added kinds need this score.
MIN_SCORE = 0.7


#: Characters of a bank account number by country, as registered.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
                23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
                29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban() -> str:
    """A number of a registered country has its length, so no word after it is taken in;
    others have any length."""
    known = {n: codes.replace(" ", "|") for n, codes in IBAN_LENGTHS.items()}
    exact = [rf"(?:{codes})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, codes in known.items()]
    other = rf"(?!{'|'.join(known.values())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}+(?:\x20?[A-Z0-9]{{1,3}})?+"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*exact, other])})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds the leftmost non-overlapping matches. A match may only
    start where a run of its characters starts or the last match ended, and
    loops are possessive: the same matches as the plain pattern, in linear time."""
    name: str
    pattern: str
    gate: str          # a cheap pattern that any match's text satisfies
    base: bool         # one of the contract's kinds, reported whatever its score
    prior: float       # score of a confirmed match without context
    context: str       # words that raise the score by 0.3


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.9,
         r"mail|contact|kontakt|correo|write|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "[0-9]\\.[0-9]", True, 0.6, r"\bip\b|address|host|server|login"),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", "[0-9][\\x20-]?[0-9]", True, 0.7, r"card|visa|master|karte|carte|tarjeta|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "\\+[0-9]", True, 0.7, r"phone|tel|call|fax|mobil|whatsapp"),
    Kind("iban", _iban(), "[A-Z]{2}[0-9]{2}", False, 0.9,
         r"iban|account|konto|compte|cuenta|bank"),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-", False, 0.4,
         r"\bssn\b|social security|tax id"),
    Kind("local_phone", r"(?<![0-9+().\x20-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])|(?<=[A-Za-z:]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
         "[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}", False, 0.4, r"phone|\btel\b|call|fax|mobil|whatsapp"),
)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the string of digits passes Luhn's check."""
    def value(c, i):
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True if an international bank account number passes the mod-97 check."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    def step(a, c):
        v = F.ascii(c)
        return F.when(v < 58, (a * 10 + v - 48) % 97).otherwise((a * 100 + v - 55) % 97)
    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.transform(F.split(match, "\\."), lambda p: F.regexp_replace(p, "^0+", "")),
                        lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        d = _digits(match)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & mod97(match)
    return F.lit(True)


#: Matches whose offsets are added up in one go: a copy of the spans so far is never larger.
CHUNK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _located(gaps: Column, hits: Column) -> Column:
    """Matches with their code point offsets and the text around them, from the
    matches and the texts between them (one more than matches)."""
    pairs = F.transform(hits, lambda m, i: F.struct(
        m.alias("m"), F.length(F.get(gaps, i)).alias("gap"),
        F.concat_ws(" ", F.substring(F.get(gaps, i), -CONTEXT, CONTEXT), F.substring(F.get(gaps, i + 1), 1, CONTEXT)).alias("near")))
    none = F.expr("cast(array() as array<struct<s:int,e:int,m:string,near:string>>)")

    def step(a, x):
        s = a["at"] + x["gap"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), x["near"].alias("near")))).alias("out"))

    def spans(chunks):
        lengths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["m"])))
        begin = F.aggregate(lengths, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        return _let(begin, lambda at: F.flatten(F.transform(chunks, lambda c, k: F.aggregate(c, F.struct(F.get(at, k).alias("at"), none.alias("out")), step, lambda a: a["out"]))))
    chunks = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / CHUNK).cast("int")), lambda k: F.slice(p, k * CHUNK + 1, CHUNK))
    return F.when(F.size(hits) == 0, none).otherwise(_let(pairs, lambda p: _let(chunks(p), spans)))


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: array of (kind, start, end, base, score), by kind
    as listed in KINDS, then start; code points, end exclusive.

    Null and empty texts give an empty array. Rows stay as they are (repeated
    rows, null ids, extra columns); a column named ``out_col`` is replaced.
    One narrow pass: nothing is shuffled, and a row's cost is linear in its text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    names = [c for c in docs.columns if c != out_col]
    keep = [F.col(f"`{c}`") for c in names]
    none = F.expr("cast(array() as array<string>)")
    raw = docs.select(*keep, *[F.when(text.rlike(k.gate), F.struct(F.split(text, k.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias("hits")))
                               .otherwise(F.struct(none.alias("gaps"), none.alias("hits"))).alias(f"__raw_{k.name}") for k in KINDS])
    return raw.select(*keep, F.concat(*[_scored(k) for k in KINDS]).alias(out_col))


def _scored(kind: Kind) -> Column:
    """The confirmed spans of one kind; those of an added kind need MIN_SCORE."""
    spans = _let(F.col(f"__raw_{kind.name}"), lambda raw: F.filter(_located(raw["gaps"], raw["hits"]), lambda x: _confirmed(kind.name, x["m"])))
    spans = F.transform(spans, lambda x: F.struct(
        F.lit(kind.name).alias("kind"), x["s"].alias("start"), x["e"].alias("end"), F.lit(kind.base).alias("base"),
        F.least(F.lit(kind.prior) + F.when(F.lower(x["near"]).rlike(kind.context), 0.3).otherwise(0.0), F.lit(1.0)).alias("score")))
    return spans if kind.base else F.filter(spans, lambda x: x["score"] >= MIN_SCORE)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    from mesonlab.llm.common import table
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    def of_kind(name):
        return F.filter("pii", lambda x: x["kind"] == name)
    count = [F.size(of_kind(k.name)).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base]
    return found.select("doc_id", *count,
                        F.sha2(joined(F.filter("pii", lambda x: x["base"])), 256).alias("base_sha256"),
                        joined(F.col("pii")).alias("spans"),
                        F.transform("pii", lambda x: x["score"]).alias("scores"))
