"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built-in column functions only. Base kinds: email, ip, card (Luhn) and phone; every base
span stays, whatever its score. Added kinds: iban (mod 97) and ssn, which stand only when
their score, raised by words near them, reaches ``MIN_SCORE``.

The patterns are the base ones with possessive loops and a look-behind, so that a long run
of letters or digits is read once instead of once for each of its positions; the matches
are the same. A match of ``email`` may start right after the one before it, hence ``\\G``.
A card match is a whole run of digits with single separators, so only runs of 16 to 19
digits are proposed.

Defined cases: very long texts are searched whole; a null or empty text has no spans; repeated rows each get their result; an
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.common import read_table, text_key
from vaultlens.llm.spans import named, with_spans

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
CONTEXT = 40        # characters on either side that may hold a telling word
MIN_SCORE = 0.6     # for added kinds
CONTEXT_BONUS = 0.3

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Score without any context word: what the pattern, or the pattern and its checksum, is worth.
WORTH = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
WORDS = {
    "email": r"e-?mail|contact|write|mailto|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|login|adresse",
    "card": r"card|visa|credit|debit|payment|karte|carte|tarjeta",
    "phone": r"phone|call|tel\b|mobile|fax|telefon|t[eé]l[eé]fono",
    "iban": r"iban|bank|account|konto|compte|cuenta",
    "ssn": r"ssn|social security",
}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total, i):
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN without spaces leaves 1 when its first four characters move to the end,
    letters count as 10 to 35, and the number is divided by 97."""
    moved = F.concat(F.substr(account, F.lit(5), F.length(account)), F.substr(account, F.lit(1), F.lit(4)))

    def step(rest, i):
        code = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), step) == 1


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, s: Column) -> Column:
    value = s["value"]
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        plain = F.replace(value, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod97(plain)
    return F.lit(True)


def _score(kind: str, s: Column) -> Column:
    near = F.lower(F.concat_ws(" ", s["before"], s["after"])).rlike(WORDS[kind])
    return F.least(F.lit(1.0), F.lit(WORTH[kind]) + F.when(near, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0)))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_score: float = MIN_SCORE) -> DataFrame:
    """``id, tkey`` and, per kind, an array of struct(start, end, value, score), by start."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(f"`{text_col}`").alias("tkey"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    d = with_spans(src, "text", PATTERNS, CONTEXT)

    def confirmed(kind):
        spans = F.transform(F.filter(kind, lambda s: _valid(kind, s)), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _score(kind, s).alias("score")))
        return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= min_score)

    return d.select("id", "tkey", *[confirmed(k).alias(k) for k in PATTERNS])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = personal_data(read_table(spark, sf_dir, "documents"))
    listed = lambda kinds: F.array_join(F.concat(*[named(k, k) for k in kinds]), ",")
    scores = F.array_join(F.concat(*[F.transform(k, lambda s: F.format_number(s["score"], 2)) for k in (*BASE, *ADDED)]), ",")
    return d.select(F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                    F.sha2(listed(BASE).cast("binary"), 256).alias("base_sha256"),
                    listed((*BASE, *ADDED)).alias("spans"), scores.alias("scores"))
