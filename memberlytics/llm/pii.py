"""Personal data by patterns, checksums and context (operator 10), in column functions only.

1. Patterns propose spans. Places come from cutting the text at the matches: the pieces between
   them and the matches themselves alternate, so running sums of lengths (in code points) are the
   starts and ends.
2. Validators confirm: Luhn for card numbers, mod 97 for account numbers (IBAN), ranges for
   addresses and digit counts.
3. Context words within CONTEXT characters before or after a span raise its score.

Base kinds (email, ip, card, phone) are all reported. The method adds two kinds: `iban` where the
checksum holds, and `id` for numbers like 123-45-6789, which score too low without a context word.

Results in special cases: null and empty texts have no spans (counts 0, hash of the empty string);
texts of any length and with any number of matches are searched whole; repeated rows and rows without a `doc_id` are returned each;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import bound, running_totals, table

# Possessive and anchored forms of the wanted patterns: the same matches without backtracking.
# A match that starts inside a run of its first class can only follow another match (\G).
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ["email", "ip", "card", "phone"]
# What a text must hold for the pattern to be worth running.
NEEDS = {"email": "@", "phone": "+"}
CONTEXT = 40
CONTEXT_WORDS = {
    "email": "e-?mail|contact|write|mail",
    "ip": "ip|address|host|server",
    "card": "card|credit|visa|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "id": "ssn|social|security|insurance|identity",
}
# Score of a span by what confirms it; spans of added kinds need THRESHOLD.
PATTERN_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "id": 0.4}
CONTEXT_SCORE = 0.2
THRESHOLD = 0.6
# Long texts are cut into parts of this many code points: a place in a text is found by counting from its front.
PART = 4096
SPAN = "struct<kind:string,start:int,stop:int,score:double>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(number))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, F.length(number) - place + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN without spaces passes its check: letters are 10 to 35, the front goes last."""
    moved = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))

    def step(rest: Column, letter: Column) -> Column:
        value = F.when(letter >= "A", F.ascii(letter) - 55).otherwise(F.ascii(letter) - 48)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.filter(F.split(moved, ""), lambda letter: letter != ""), F.lit(0), step) == 1


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = F.regexp_replace(match, r"\b0+(?=[0-9])", "")
        return part.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}")
    if kind == "card":
        number = digits(match)
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        account = F.replace(match, F.lit(" "))
        return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)
    return F.lit(True)


def parts(text: Column) -> Column:
    """`text` in parts of PART code points."""
    return F.when(F.length(text) <= PART, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)))


def part_at(number: Column) -> Column:
    return F.coalesce(F.get("parts", number), F.lit(""))


def before(place: Column) -> Column:
    """The CONTEXT code points of the text in front of `place`."""
    number = F.floor(place / PART).cast("int")
    return F.right(F.concat(part_at(number - 1), F.left(part_at(number), place - number * PART)), F.lit(CONTEXT))


def after(place: Column) -> Column:
    """The CONTEXT code points of the text from `place` on."""
    number = F.floor(place / PART).cast("int")
    return F.substring(F.concat(part_at(number), part_at(number + 1)), place - number * PART + 1, F.lit(CONTEXT))


def spans_of(kind: str) -> Column:
    """Array of valid spans of `kind` in column `text`, cut into `parts`, by start."""
    gaps = F.transform(F.split("text", PATTERNS[kind], -1), F.length)

    def place(matches: Column) -> Column:
        ends = running_totals(F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda gap, match: gap + F.length(match)))
        return F.zip_with(
            matches, ends, lambda match, end: F.struct((end - F.length(match)).alias("start"), end.alias("stop"), match.alias("match"))
        )

    placed = bound(F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0)), place)
    confirmed = F.filter(placed, lambda span: valid(kind, span["match"]))

    def scored(span: Column) -> Column:
        near = F.concat(before(span["start"]), span["match"], after(span["stop"]))
        context = F.lower(near).rlike(rf"\b(?:{CONTEXT_WORDS[kind]})\b")
        score = F.lit(PATTERN_SCORE[kind]) + F.when(context, CONTEXT_SCORE).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["stop"].alias("stop"), score.alias("score"))

    needed = F.contains("text", F.lit(NEEDS[kind])) if kind in NEEDS else F.col("text").rlike(PATTERNS[kind])
    return F.when(needed, F.transform(confirmed, scored)).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """`doc_id`, and per kind an array of spans with scores."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("parts", parts(F.col("text")))
    found = texts.select("doc_id", *[spans_of(kind).alias(kind) for kind in PATTERNS])
    added = [kind for kind in PATTERNS if kind not in BASE]
    return found.withColumns({kind: F.filter(kind, lambda span: span["score"] >= THRESHOLD) for kind in added})


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(F.concat(*BASE)), 256).alias("base_sha256"),
        written(F.concat(*PATTERNS)).alias("spans"),
    )
