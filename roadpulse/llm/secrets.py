"""Secret scan: fixed patterns, and windows of high Shannon entropy over candidate strings.

Everything is column expressions on the row of the document: nothing is shuffled, and only texts
that hold a possible match go beyond one pass per gate. Positions come from the lengths of what a
pattern matches and of what stands between.

A candidate is a run of at least ``WINDOW`` characters of the base64 alphabets with its padding; an equals sign
within parts a name from its value, so an allowed name does not cover what is assigned to it. A window slides
over it: each step adds the count of the entering character, takes off that of the leaving one, and
corrects the sum of n * log2(n) by these two terms only, so the entropy is log2(W) - sum / W.
The window's character class (hexadecimal digits only, or wider) sets the threshold it has to
reach, and it must hold a digit and a letter. Candidates on the allow-list are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text

# The patterns of the base kinds, in the order of the kinds.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}={{0,2}}"
# Bits a window has to reach, by class.
HEX_BITS, WIDE_BITS = 3.0, 3.7
# What looks random but is no secret: examples, digests in integrity attributes, UUIDs, alphabets.
ALLOW = (
    r"(?i)example|^sha(1|256|384|512)-|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    r"|0123456789|abcdefghij|qwertyuiop"
)
# Character codes of candidates: from + to z.
LOW_CODE, CODES = 43, 80


def positions(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, size>> of all matches: code points, end exclusive; size is that of the group."""
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length).alias("hit"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length).alias("size"),
    )
    zero = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,size:int>>").alias("out")
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["hit"], F.lit(0))
        found = F.array(F.struct(start.alias("start"), end.alias("end"), x["size"].alias("size")))
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], found)).alias("out"))

    return F.aggregate(zipped, zero, step, lambda acc: acc["out"])


def tagged(spans: Column, kind: str) -> Column:
    """Spans long enough for their kind as structs that sort by start, then by kind."""
    order = KINDS.index(kind)
    return F.transform(
        F.filter(spans, lambda s: s["size"] >= LEAST.get(kind, 0)),
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def hot_range(candidate: Column) -> Column:
    """struct<first, last>: first start and last end of the windows over their threshold, null if there is none."""
    terms = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)])
    steps = let(
        F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - LOW_CODE),
        lambda codes: F.transform(
            codes,
            lambda c, i: F.struct(c.alias("enter"), F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(-1).alias("leave"), i.alias("i")),
        ),
    )
    codes_of = lambda a, b: (ord(a) - LOW_CODE, ord(b) - LOW_CODE)
    digit = lambda c: F.when(c.between(*codes_of("0", "9")), 1).otherwise(0)
    letter = lambda c: F.when(c.between(*codes_of("A", "Z")) | c.between(*codes_of("a", "z")), 1).otherwise(0)
    wide = lambda c: F.when(
        (c >= 0) & ~(c.between(*codes_of("0", "9")) | c.between(*codes_of("a", "f")) | c.between(*codes_of("A", "F"))), 1
    ).otherwise(0)
    zero = F.struct(
        F.array_repeat(F.lit(0), CODES).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("digits"), F.lit(0).alias("letters"),
        F.lit(0).alias("wide"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def slide(acc: Column, x: Column) -> Column:
        enter, leave = x["enter"], x["leave"]
        n, m = F.get(acc["counts"], enter), F.get(acc["counts"], leave)
        change = F.get(terms, n + 1) - F.get(terms, n) - F.when(leave >= 0, F.get(terms, m) - F.get(terms, m - 1)).otherwise(0.0)
        total = acc["sum"] + F.when(enter == leave, 0.0).otherwise(change)
        digits = acc["digits"] + digit(enter) - digit(leave)
        letters = acc["letters"] + letter(enter) - letter(leave)
        others = acc["wide"] + wide(enter) - wide(leave)
        bits = math.log2(WINDOW) - total / WINDOW
        hot = (x["i"] >= WINDOW - 1) & (digits > 0) & (letters > 0) & (bits >= F.when(others > 0, WIDE_BITS).otherwise(HEX_BITS))
        counts = F.transform(acc["counts"], lambda v, k: v + F.when(k == enter, 1).otherwise(0) - F.when(k == leave, 1).otherwise(0))
        return F.struct(
            counts.alias("counts"), total.alias("sum"), digits.alias("digits"), letters.alias("letters"), others.alias("wide"),
            F.coalesce(acc["first"], F.when(hot, x["i"] - (WINDOW - 1))).alias("first"),
            F.when(hot, x["i"] + 1).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(steps, zero, slide, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def entropy_spans(text: Column) -> Column:
    """Spans of candidates that are not on the allow-list and have a window of high entropy."""
    strings = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    found = F.transform(
        F.filter(
            F.arrays_zip(strings.alias("string"), positions(text, CANDIDATE).alias("at")),
            lambda c: c["string"].rlike("[0-9]") & c["string"].rlike("[A-Za-z]") & ~c["string"].rlike(ALLOW),
        ),
        lambda c: F.struct(c["at"]["start"].alias("at"), hot_range(c["string"]).alias("hot")),
    )
    return F.transform(
        F.filter(found, lambda c: c["hot"]["first"].isNotNull()),
        lambda c: F.struct(
            (c["at"] + c["hot"]["first"]).alias("start"), (c["at"] + c["hot"]["last"]).alias("end"), F.lit(0).alias("size")
        ),
    )


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    ``spans`` lists kind:start:end in code points. An entropy span inside a base span is not
    repeated. A null text is empty: no spans, and the digest is that of the empty string. Texts
    are read whole; repeated rows give repeated results; no other column is read.
    """
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    text = F.col("text")
    # Hexadecimal runs, access keys and candidates all hold a run of WINDOW characters. Runs that are too short are
    # dropped in the pattern where that cannot change what the longer ones cover.
    runs = F.col("has_run")
    found = (
        docs.select("doc_id", whole_text().alias("text"))
        .withColumns({"has_assign": text.rlike(ASSIGN), "has_run": text.rlike(rf"[A-Za-z0-9+/_=-]{{{WINDOW}}}")})
        .withColumns(
            {
                "assign": F.when(F.col("has_assign"), tagged(positions(text, ASSIGN, 2), "assign")).otherwise(none),
                "access": F.when(runs & F.contains(text, F.lit("AKIA")), tagged(positions(text, ACCESS), "access")).otherwise(none),
                "hex": F.when(runs, tagged(positions(text, HEX.replace("+", "{24,}")), "hex")).otherwise(none),
                "entropy": F.when(runs, tagged(entropy_spans(text), "entropy")).otherwise(none),
            }
        )
        .drop("text")
    )
    pair = F.struct(F.sort_array(F.concat("assign", "access", "hex")).alias("base"), F.col("entropy").alias("entropy"))
    new = lambda p: F.filter(
        p["entropy"], lambda e: ~F.exists(p["base"], lambda b: (b["start"] <= e["start"]) & (b["end"] >= e["end"]))
    )
    spans = let(pair, lambda p: F.struct(p["base"].alias("base"), new(p).alias("new")))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")], spans.alias("s")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size("s.new").cast("long").alias("n_entropy"),
        F.sha2(listed(F.col("s.base")), 256).alias("base_sha256"), listed(F.sort_array(F.concat("s.base", "s.new"))).alias("spans"),
    )


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
