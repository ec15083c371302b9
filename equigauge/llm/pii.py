"""Personal data in texts: patterns propose spans, checksums confirm them, words before them adjust their score.

DataFrame functions only. A pattern is applied to the whole text once; what it finds and what lies between gives the
places, as code points. The patterns use possessive repeats and look back at run starts, so that long runs of digits or
letters take linear time; what they find is the same as without.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.llm.text import whole

#: Finds are numbered in blocks of this size, so that long lists of finds cost no quadratic time.
BLOCK = 256
#: Code points before a span that are searched for context words.
CONTEXT = 32
THRESHOLD = 0.5
NEAR = 0.35


@dataclass(frozen=True)
class Kind:
    """`base` spans count whatever their score; others need the threshold. `hint` must occur in texts with such spans."""

    name: str
    pattern: str
    score: float
    words: tuple[str, ...]
    base: bool = True
    hint: str = ""

    def confirmed(self, found: Column) -> Column:
        return CONFIRM[self.name](found)


def _bare(found: Column, junk: str = r"[^0-9]") -> Column:
    return F.regexp_replace(found, junk, "")


_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def mod_97(found: Column) -> Column:
    """Whether an account number, its first four characters moved to the end, letters as 10 to 35, leaves 1."""
    turned = F.split(F.concat(F.substring(found, 5, 40), F.substring(found, 1, 4)), "")
    value = lambda c: F.when(c.between("A", "Z"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    step = lambda rest, c: (rest * F.when(c.between("A", "Z"), 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step) == 1


CONFIRM = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda m: F.length(_bare(m)).between(16, 19) & F.call_function("luhn_check", _bare(m)),
    "phone": lambda m: F.length(_bare(m)).between(8, 15),
    "iban": mod_97,
    "ssn": lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
}
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9,
         ("mail", "contact", "write"), hint="@"),
    Kind("ip", r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}", 0.6, ("ip", "address", "host", "server"), hint="."),
    Kind("card", r"[0-9](?<![0-9][\x20-]?[0-9])(?:[\x20-]?[0-9]){15,}+", 0.8, ("card", "visa", "credit", "pay")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, ("call", "phone", "tel", "mobile", "fax"), hint="+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", 0.6, ("iban", "account", "bank"), base=False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, ("ssn", "social security", "tax id"), base=False, hint="-"),
)


def _starts(steps: Column, gaps: Column) -> Column:
    """Start of every find from `steps` (length of gap and find) and `gaps`: sums within blocks on sums of blocks."""
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(steps) / BLOCK).cast("int") - 1), lambda b: F.struct(
        b.alias("b"), F.aggregate(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda a, x: a + x).alias("sum")))
    placed = F.aggregate(
        blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.struct((a["at"] + x["sum"]).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))["out"]
    inside = F.transform(placed, lambda at, b: F.aggregate(
        F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)), F.struct(at.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))["out"])
    return F.zip_with(F.flatten(inside), gaps, lambda at, gap: at + gap)


def _confirmed_spans(k: Kind) -> Column:
    """Spans of kind `k` from the columns pii_found, pii_between and pii_starts, which must not be empty."""
    def span(i: Column) -> Column:
        m, at = F.get("pii_found", i), F.get("pii_starts", i)
        before = F.lower(F.right(F.get("pii_between", i), F.lit(CONTEXT)))
        raised = F.when(before.rlike("|".join(k.words)), F.lit(NEAR)).otherwise(F.lit(0.0))
        return F.struct(F.lit(k.name).alias("kind"), at.alias("start"), (at + F.length(m)).alias("end"), m.alias("value"),
                        F.least(F.lit(1.0), F.lit(k.score) + raised).alias("score"))

    spans = F.transform(F.sequence(F.lit(0), F.size("pii_found") - 1), span)
    return F.filter(spans, lambda s: k.confirmed(s["value"]) & (F.lit(k.base) | (s["score"] >= THRESHOLD)))


def find_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, column: str = "text") -> DataFrame:
    """`docs` with one column per kind, `pii_<kind>`: array of (kind, start, end, value, score), by start.

    Places are code points, the end exclusive. NULL text counts as empty and has no spans. Finds that the checksum or
    form does not confirm are dropped; so are finds below the threshold unless their kind is a base one. A context word
    in the `CONTEXT` code points before the span, back to the span before it, adds `NEAR` to the score, at most 1.
    """
    out = docs.withColumn("pii_text", whole(column))
    none = F.array().cast("array<string>")
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>")
    text, some = F.col("pii_text"), F.size("pii_found") > 0
    for k in kinds:
        hinted = F.contains(text, F.lit(k.hint)) if k.hint else F.lit(True)
        gaps = F.transform(F.slice("pii_between", F.lit(1), F.size("pii_found")), F.length)
        steps = F.zip_with("pii_found", "pii_gaps", lambda m, gap: F.length(m) + gap)
        out = (
            out.withColumn("pii_found", F.when(hinted, F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none))
            .withColumn("pii_between", F.when(some, F.split(text, k.pattern, -1)))
            .withColumn("pii_gaps", F.when(some, gaps))
            .withColumn("pii_starts", F.when(some, _starts(steps, F.col("pii_gaps"))))
            .withColumn(f"pii_{k.name}", F.when(some, _confirmed_spans(k)).otherwise(empty))
            .drop("pii_found", "pii_between", "pii_gaps", "pii_starts")
        )
    return out.drop("pii_text")


def redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """`docs` with every confirmed base value of the text replaced by its kind in brackets, longest values first."""
    found = find_spans(docs, column=column)
    names = [f"pii_{k.name}" for k in KINDS]
    values = F.array_distinct(F.transform(F.concat(*names), lambda s: F.struct(
        (-F.length(s["value"])).alias("n"), s["value"].alias("value"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("label"))))
    clean = F.aggregate(F.array_sort(values), whole(column), lambda t, v: F.replace(t, v["value"], v["label"]))
    return found.withColumn(column, clean).drop(*names)


def _written(*names: str) -> Column:
    return F.array_join(F.transform(F.concat(*names), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, for every row of `docs` (doc_id, text).

    NULL and empty texts have counts of 0 and empty lists; rows may repeat and doc_id may be NULL, each row is told for
    itself. An empty table gives no rows. Other columns are ignored.
    """
    found = find_spans(docs.select("doc_id", "text"))
    base = [k.name for k in KINDS if k.base]
    return found.select(
        "doc_id", *[F.size(f"pii_{n}").cast("long").alias(f"n_{n}") for n in base],
        F.sha2(_written(*[f"pii_{n}" for n in base]), 256).alias("base_sha256"),
        _written(*[f"pii_{k.name}" for k in KINDS]).alias("spans"))
