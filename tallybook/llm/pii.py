"""Personal data: fixed formats, and identifiers found by bootstrapped contexts.

All in DataFrame functions. Formats are found by regular expressions that scan each text in
linear time. For the contexts, values after a cue ("name = value", "name: value") form a graph
of cues and values; values of a known format are the seeds. Confidence flows from seeds to
cues and back over a few rounds, and every value after a confident cue is an identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import native
from tallybook.llm.scratch import keep

KINDS = ["email", "ip", "card", "phone"]
CONTEXT = "context"
ROUNDS = 3
CONFIDENT = 0.5
MIN_VALUES = 3  # distinct values a cue needs before it can be confident

# A match starts where a run of its first class starts, or where the last match ended; a
# start inside the run would fail or succeed alike, so leftmost matches stay the same and a
# long run is not tried from each of its characters.
_LOCAL = "A-Za-z0-9._%+-"
FORMATS = {
    "email": f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
# Cheap tests that every text with a valid match passes.
HINTS = {
    "email": "@[A-Za-z0-9-]+\\.",
    "ip": "[0-9]\\.[0-9]",
    "card": "[0-9](?:[\\x20-]?[0-9]){12}",
    "phone": "\\+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# A cue starts where a run of name characters starts, behind numbers and signs there. Its value
# runs on to a stop character. A run without a digit is passed over as a whole, but for a name at
# its end, and gives an empty value; so no cue in it looks for the digit again.
_STOP = "\\s\"',;()\\[\\]"
_NAME = "\\p{L}\\p{N}_.-"
CUE = (
    f"(?<![{_NAME}])(?:\\p{{N}}[\\p{{L}}\\p{{N}}_]*+[.-]++|[.-]++)*+"
    f"([\\p{{L}}_][{_NAME}]++)\\x20?([:=#])\\x20?[\"'(\\[]?"
    f"(?:(?=[^{_STOP}0-9]*+[0-9])([^{_STOP}]{{6,}})(?<![.:!?])|(?![^{_STOP}0-9]*+[0-9])"
    f"(?:[^{_STOP}0-9]*(?<![{_NAME}])(?=[{_NAME}]++[:=#]*+(?:[{_STOP}]|$))|[^{_STOP}0-9]*+))"
)
CUE_HINT = f"[:=#]\\x20?[\"'(\\[]?[^{_STOP}]{{6}}"
SEED = (
    f"^(?:[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++|{_BYTE}(?:\\.{_BYTE}){{3}}"
    "|\\+[0-9]{9,15}|[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"
)


def _matches(text: Column, pattern: str, groups: list[int]) -> Column:
    """Matches with code-point offsets: array of (start, end, g0, g1, ...) for the groups.

    The pieces between the matches give the offsets.
    """
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]
    names = [f"g{i}" for i in range(len(groups))]
    ends = lambda m: F.aggregate(
        F.zip_with(m["g0"], m["pieces"], lambda g, p: F.struct(g.alias("g"), p.alias("p"))),
        F.array().cast("array<int>"),
        lambda a, x: F.when(x["g"].isNull(), a).otherwise(
            F.concat(
                a,
                F.array(
                    F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
                    + F.char_length(x["p"])
                    + F.char_length(x["g"])
                ),
            )
        ),
    )
    parts = F.struct(
        *[f.alias(n) for f, n in zip(found, names, strict=True)],
        F.split(text, pattern, -1).alias("pieces"),
    )

    def spans(m: Column) -> Column:
        return native.let(
            ends(m),
            lambda e: F.transform(
                m["g0"],
                lambda g, i: F.struct(
                    (F.get(e, i) - F.char_length(g)).alias("start"),
                    F.get(e, i).alias("end"),
                    *[F.get(m[n], i).alias(n) for n in names],
                ),
            ),
        )

    return native.let(parts, spans)


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]+", "")
    if kind == "ip":
        return match.rlike(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_CUES = "array<struct<pattern:string,value:string,start:int,end:int>>"


def format_spans(text: Column, kind: str) -> Column:
    """Valid spans of one format, by start."""
    spans = F.transform(
        F.filter(_matches(text, FORMATS[kind], [0]), lambda m: _valid(kind, m["g0"])),
        lambda m: F.struct(F.lit(kind).alias("kind"), m["start"], m["end"]),
    )
    return F.when(text.rlike(HINTS[kind]), spans.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def cue_values(text: Column) -> Column:
    """Values after a cue: array of (pattern, value, start, end)."""
    made = F.transform(
        F.filter(_matches(text, CUE, [0, 1, 2, 3]), lambda m: m["g3"] != ""),
        lambda m: F.struct(
            F.concat_ws(" ", F.lower(m["g1"]), m["g2"]).alias("pattern"),
            F.lower(m["g3"]).alias("value"),
            (m["end"] - F.char_length(m["g3"])).alias("start"),
            m["end"].alias("end"),
        ),
    )
    return F.when(text.rlike(CUE_HINT), made.cast(_CUES)).otherwise(F.array().cast(_CUES))


def scan(docs: DataFrame, carry: bool = False) -> DataFrame:
    """One pass over the texts: spans of each format and values after cues.

    ``carry`` keeps the whole row as ``__doc``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        *[F.struct("*").alias("__doc")] * carry,
        F.col("doc_id").cast("bigint").alias("__id"),
        F.xxhash64(text).alias("__text_hash"),
        *[format_spans(text, k).alias(f"__{k}") for k in KINDS],
        cue_values(text).alias("__cues"),
    )


def confident_patterns(cues: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Cues whose values are identifiers, with their confidence.

    ``cues`` has pattern and value. A cue's confidence is the mean score of its distinct
    values, lessened for few values; a value's score is 1 for a seed, else the probability
    that one of its cues is right. Values under one cue are averaged, so a cue with seeds
    carries unseen values, and those carry other cues.
    """
    edges = keep(
        cues.groupBy("pattern", "value").agg(F.count("*").alias("n"))
        .withColumn("seed", F.col("value").rlike(SEED).cast("double")),
        "cues",
    )
    scored = edges.withColumn("score", F.col("seed"))
    for step in range(rounds):
        patterns = scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("confidence"),
            F.count("*").alias("values"),
        )
        if step + 1 == rounds:
            break
        values = (
            edges.join(patterns, "pattern")
            .groupBy("value")
            .agg(
                F.greatest(
                    F.max("seed"), 1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))
                ).alias("score")
            )
        )
        scored = edges.join(values, "value")
    return patterns.where((F.col("confidence") >= CONFIDENT) & (F.col("values") >= MIN_VALUES))


def _with_contexts(scanned: DataFrame) -> DataFrame:
    """Add the context spans that overlap no format span, as ``__context``."""
    none = F.array().cast(_SPANS)
    plain = scanned.where(F.size("__cues") == 0).withColumn("__context", none)
    cued = scanned.where(F.size("__cues") > 0)
    rows = cued.select("__id", "__text_hash", F.explode("__cues").alias("c")).select(
        "__id", "__text_hash", "c.*"
    )
    found = (
        rows.join(confident_patterns(rows.select("pattern", "value")).select("pattern"), "pattern")
        .groupBy("__id", "__text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__found"))
        .withColumnsRenamed({"__id": "__id2", "__text_hash": "__hash2"})
    )
    joined = cued.join(
        found,
        F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__text_hash") == F.col("__hash2")),
        "left",
    )
    base = F.concat(*[F.col(f"__{k}") for k in KINDS])
    free = F.filter(
        F.coalesce(F.col("__found"), F.array().cast("array<struct<start:int,end:int>>")),
        lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    context = F.transform(
        free, lambda c: F.struct(F.lit(CONTEXT).alias("kind"), c["start"], c["end"])
    ).cast(_SPANS)
    return plain.unionByName(
        joined.withColumn("__context", context).drop("__id2", "__hash2", "__found")
    )


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """Personal data of each document: counts, digest of the format spans, and all spans.

    docs needs ``doc_id`` and ``text``; other columns are ignored. Offsets are code points,
    ends exclusive. A null or empty text has no spans. Rows with equal ids are judged one by
    one; an empty table gives no rows. Context spans never overlap format spans.
    """
    rows = _with_contexts(keep(scan(docs), "pii"))
    base = F.concat(*[F.col(f"__{k}") for k in KINDS])
    return rows.select(
        F.col("__id").alias("doc_id"),
        *[F.size(f"__{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, F.col("__context"))).alias("spans"),
        F.size("__context").cast("bigint").alias("n_context"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets.

    Columns and rows stay; overlapping spans become one, under the kind that starts first, and of
    those that start together under the one that ends first. ``n_chars``, if there is one, is counted
    anew for changed texts. Null and empty texts stay as they are, long ones are searched whole, repeated
    rows change alike, and an empty table gives no rows.
    """
    rows = _with_contexts(keep(scan(docs, carry=True), "pii"))
    spans = F.sort_array(
        F.transform(
            F.concat(*[F.col(f"__{k}") for k in [*KINDS, CONTEXT]]),
            lambda s: F.struct(s["start"], s["end"], s["kind"]),
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("__doc.text").cast("string")

    def step(a: Column, s: Column) -> Column:
        before = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], before, tag))
            .otherwise(a["out"])
            .alias("out"),
        )

    made = F.aggregate(
        spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, 1 << 30))
    )
    found = F.size(spans) > 0
    doc = F.col("__doc")
    changed = doc.withField("text", made)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withField("n_chars", F.char_length(made).cast(kind))
    return rows.select(F.when(found, changed).otherwise(doc).alias("__doc")).select("__doc.*")
