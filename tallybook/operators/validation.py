"""Row rules, and the split of raw rows into valid and quarantined ones.

A rule is a message and a condition that is true when the row breaks it, as a column
or as SQL text. All rules of a profile become one array column, so a row is checked in
one pass and every message is kept. Long rule lists are SQL text: it reaches Spark in
one call, where each column operation would be a call of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallybook import schema
from tallybook.functions import dates, text


# --- fixed values: messages that reports and consumers match on -----------------
MISSING_FIELD = "Missing required field: {field}"
NULL_FIELD = "Required field '{field}' cannot be None"
BLANK_FIELD = "Required field '{field}' cannot be empty"
WRONG_TYPE = "Field '{field}' has incorrect type. Expected: {expected}, Actual: "
RECORD_WITHOUT_ID = "Record ID is required"
RECORD_BELOW_ZERO = "Record value must be non-negative"


@dataclass(frozen=True)
class Rule:
    message: str
    broken: Column | str


def broken_messages(rules: Sequence[Rule]) -> Column:
    """One entry per rule, in their order: its message where it is broken, else NULL."""
    if all(isinstance(r.broken, str) for r in rules):
        cases = ", ".join(
            f"CASE WHEN {r.broken} THEN {sql_text(r.message)} END" for r in rules
        )
        return F.expr(f"array({cases})").cast("array<string>")
    broken = [F.expr(r.broken) if isinstance(r.broken, str) else r.broken for r in rules]
    messages = [F.when(b, F.lit(r.message)) for b, r in zip(broken, rules, strict=True)]
    return F.array(*messages).cast("array<string>")


def error_list(rules: Sequence[Rule]) -> Column:
    """Messages of all broken rules; a rule whose condition is NULL is not broken."""
    return F.array_compact(broken_messages(rules))


def sql_text(value: str) -> str:
    """A string as a SQL literal; backslashes stay as they are."""
    return "r'" + value + "'" if "'" not in value else 'r"' + value + '"'


def sql_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(map(sql_text, values)) + ")"


# --- JSON documents -------------------------------------------------------------

# Strict JSON: no single quotes, whole value only (see read_documents).
_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def read_documents(df: DataFrame, fields: Sequence[str], value: str = "value") -> DataFrame:
    """Add `doc`, a struct of one variant per field, and `doc_keys`.

    The text is parsed once, as the only element of an array, so trailing text or a
    second object gives no document. The generator keeps Spark from repeating the
    parse in every later filter and projection. `doc` is NULL unless the text is
    exactly one JSON object; an absent field is NULL, a JSON null is a variant null.
    """
    doc_type = ", ".join(f"`{f}`: variant" for f in fields)
    options = ", ".join(f"'{k}', '{v}'" for k, v in _JSON_OPTIONS.items())
    parsed = f"from_json(concat('[', `{value}`, ']'), 'array<struct<{doc_type}>>', map({options}))"
    once = (
        f"inline(transform(array({parsed}), d -> named_struct("
        "'doc', CASE WHEN size(d) = 1 AND NOT __early THEN get(d, 0) END)))"
    )
    df = df.withColumn("__early", text.closes_early(F.col(value)))
    return df.select("*", F.expr(once)).drop("__early").withColumn(
        "doc_keys", F.when(F.col("doc").isNotNull(), F.json_object_keys(F.col(value)))
    )


def json_type(field: Column) -> Column:
    """STRING, BIGINT, VOID, ... for a variant; NULL for an absent field."""
    return F.schema_of_variant(field)


def json_text(field: Column) -> Column:
    return F.try_variant_get(field, "$", "string")


def _lax_int(kind: Column, raw: Column, to: str = "int") -> Column:
    """Whole number from a JSON number, boolean or trimmed number text; NULL otherwise."""
    whole = F.regexp_replace(F.regexp_replace(raw, r"\.0*\z", ""), r"(?<=\d)_(?=\d)", "")
    return (
        F.when(kind == "BIGINT", raw.try_cast(to))
        .when(kind == "BOOLEAN", raw.cast("boolean").cast("int").cast(to))
        .when(
            (kind != "VOID") & whole.rlike(r"^[+-]?\d+\z"),
            whole.try_cast(to),
        )
    )


def _lax_timestamp(kind: Column, raw: Column) -> Column:
    """Trimmed ISO text, or Unix time in seconds (milliseconds beyond 2e10)."""
    epoch = raw.try_cast("decimal(38,6)")
    micros = F.when(F.abs(epoch) <= 20_000_000_000, epoch * 1_000_000).otherwise(epoch * 1_000)
    from_epoch = F.when(
        raw.rlike(r"^[+-]?\d+(\.\d*)?\z"),
        F.timestamp_micros(F.floor(micros).try_cast("bigint")),
    )
    return F.when(
        ~kind.isin("BOOLEAN", "VOID"), F.coalesce(dates.parse_iso_utc(raw), from_epoch)
    )


def check_visit_events(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Check raw (source_key, value) rows against the visit-event rules.

    Returns the input columns but `value`, the ledger columns and `errors`; a valid
    row has no errors. `strict` adds the published consumer rules.

    Projections that each read plain columns of the one before: JSON type and text per
    field, trimmed text, typed columns, messages. No field is extracted or parsed twice.
    """
    carried = [c for c in raw.columns if c != "value"]
    names = schema.LEDGER_COLUMNS
    known = "array" + sql_list(names)
    surplus = f"size(array_except(doc_keys, {known})) > 0 AS _surplus"
    quoted = [f"`{c}`" for c in carried]
    fields = _field_texts(read_documents(raw, names), names, [*quoted, surplus])
    words = ("action", "datatype")  # compared as written; other text is trimmed
    fields = fields.withColumns(
        {
            f"_text_{c}": text.strip_whitespace(F.col(f"_text_{c}"))
            for c in names
            if c not in words
        }
    )

    typed = {c: F.col(f"_text_{c}") for c in names}
    typed["study"] = F.when(F.col("_kind_study").isNull(), schema.DEFAULT_STUDY).otherwise(
        typed["study"]
    )
    typed["pipeline_adcid"] = _lax_int(F.col("_kind_pipeline_adcid"), typed["pipeline_adcid"])
    typed["timestamp"] = _lax_timestamp(F.col("_kind_timestamp"), typed["timestamp"])
    rows = fields.select(
        *carried,
        "_doc",
        "_surplus",
        *[f"_kind_{c}" for c in names],
        *[typed[f.name].cast(f.dataType).alias(f.name) for f in schema.LEDGER],
    )

    rules = _visit_event_rules() + (strict_rules() if strict else [])
    # Spark compiles the rules as a projection of their own; inside array_compact or a generator it
    # would interpret each of them for each row.
    judged = rows.select(*carried, *names, broken_messages(rules).alias("_broken"))
    return judged.select(*carried, *names, once(F.array_compact("_broken")).alias("errors"))


def once(value: Column) -> Column:
    """The value through a generator, so that a later filter on it does not compute it again.

    Spark moves a filter below plain projections, and with it all that its columns are made of.
    """
    return F.explode(F.array(value))


def _field_texts(docs: DataFrame, names: Sequence[str], others: Sequence[str]) -> DataFrame:
    """`_doc`, and per field its JSON type `_kind_<field>` and its text `_text_<field>`."""
    return docs.selectExpr(
        *others,
        "doc IS NOT NULL AS _doc",
        *[f"schema_of_variant(doc.`{c}`) AS `_kind_{c}`" for c in names],
        *[f"CAST(doc.`{c}` AS STRING) AS `_text_{c}`" for c in names],
    )


def _visit_event_rules() -> list[Rule]:
    """Rules over the typed columns and each field's JSON type `_kind_<field>`."""
    texts = [c for c in schema.LEDGER_COLUMNS if c not in ("pipeline_adcid", "timestamp")]
    nullable = {c: "'STRING', 'VOID'" for c in schema.NULLABLE}
    form = sql_text(schema.FORM_DATATYPE)
    return [
        Rule("JSON decode error", "NOT _doc"),
        *[Rule(f"{c}: field required", f"_doc AND _kind_{c} IS NULL") for c in schema.REQUIRED],
        *[
            Rule(f"{c}: not a string", f"_kind_{c} NOT IN ({nullable.get(c, "'STRING'")})")
            for c in texts
        ],
        Rule(
            "action: unknown value",
            f"_kind_action = 'STRING' AND action NOT IN {sql_list(schema.ACTIONS)}",
        ),
        Rule(
            "datatype: unknown value",
            f"_kind_datatype = 'STRING' AND datatype NOT IN {sql_list(schema.DATATYPES)}",
        ),
        Rule(
            "pipeline_adcid: not an integer",
            "_kind_pipeline_adcid IS NOT NULL AND pipeline_adcid IS NULL",
        ),
        Rule(
            "ptid: bad pattern",
            f"_kind_ptid = 'STRING' AND NOT rlike(ptid, {sql_text(schema.PTID_PATTERN)})",
        ),
        Rule(
            "visit_date: bad pattern",
            "_kind_visit_date = 'STRING' AND NOT "
            f"rlike(visit_date, {sql_text(schema.VISIT_DATE_PATTERN)})",
        ),
        Rule("timestamp: not a date-time", "_kind_timestamp IS NOT NULL AND timestamp IS NULL"),
        Rule("module: required for form", f"datatype = {form} AND module IS NULL"),
        Rule(
            "module: only allowed for form",
            f"datatype <> {form} AND datatype IN {sql_list(schema.DATATYPES)} "
            "AND module IS NOT NULL",
        ),
        Rule("extra field", "_surplus"),
    ]


def strict_rules() -> list[Rule]:
    """The published consumer profile, on typed ledger columns."""
    nonempty = ("study", "project_label", "center_label", "gear_name", "visit_number", "datatype")
    return [
        Rule("ptid: only capitals and digits", r"NOT rlike(ptid, r'^[A-Z0-9]+\z')"),
        Rule("pipeline_adcid: below 1", "pipeline_adcid < 1"),
        Rule("visit_number: field required", "visit_number IS NULL"),
        Rule(
            "visit_date: not a calendar date",
            f"rlike(visit_date, {sql_text(schema.VISIT_DATE_PATTERN)}) "
            "AND try_cast(visit_date AS date) IS NULL",
        ),
        *[Rule(f"{c}: empty", f"{c} = ''") for c in nonempty],
    ]


def check_records(
    raw: DataFrame, model: T.StructType, rules: Sequence[Rule] = (), value: str = "value"
) -> DataFrame:
    """Check JSON records against any model: its types, its required fields, its rules.

    A non-nullable field of the model must be there and not null; text must be JSON
    text, numbers and times are read leniently, a variant field must be an object.
    Unknown fields are ignored. Rules see the typed columns. Returns the input columns
    but the text, the model's columns and `errors`.
    """
    carried = [c for c in raw.columns if c != value]
    names = model.fieldNames()
    quoted = [f"`{c}`" for c in carried]
    raws = [f"doc.`{c}` AS `_raw_{c}`" for c in names]
    fields = _field_texts(read_documents(raw, names, value), names, [*quoted, *raws])
    fields = fields.withColumns(
        {
            f"_text_{f.name}": text.strip_whitespace(F.col(f"_text_{f.name}"))
            for f in model
            if not isinstance(f.dataType, T.StringType)
        }
    )
    typed = [_typed_field(f).alias(f.name) for f in model]
    rows = fields.select(*carried, "_doc", *[f"_kind_{c}" for c in names], *typed)
    checks = [Rule("JSON decode error", "NOT _doc")]
    for f in model:
        kind = f"`_kind_{f.name}`"
        checks.append(
            Rule(
                f"{f.name}: not a {f.dataType.simpleString()}",
                f"{kind} IS NOT NULL AND `{f.name}` IS NULL"
                + (f" AND {kind} <> 'VOID'" if f.nullable else ""),
            )
        )
        if not f.nullable:
            checks.append(Rule(f"{f.name}: field required", f"_doc AND {kind} IS NULL"))
    return rows.select(*carried, *names, error_list([*checks, *rules]).alias("errors"))


def _typed_field(field: T.StructField) -> Column:
    kind, raw = F.col(f"_kind_{field.name}"), F.col(f"_text_{field.name}")
    if isinstance(field.dataType, T.StringType):
        return F.when(kind == "STRING", raw)
    if isinstance(field.dataType, T.TimestampType):
        return _lax_timestamp(kind, raw)
    if isinstance(field.dataType, T.VariantType):
        return F.when(kind.startswith("OBJECT"), F.col(f"_raw_{field.name}"))
    if isinstance(field.dataType, T.IntegralType):
        return _lax_int(kind, raw, field.dataType.simpleString())
    if isinstance(field.dataType, T.FractionalType):
        as_number = F.when(kind == "BOOLEAN", raw.try_cast("boolean").cast("int").cast("string"))
        return F.coalesce(as_number, raw).try_cast(field.dataType)
    if isinstance(field.dataType, T.BooleanType):
        return raw.try_cast("boolean")
    raise ValueError(f"{field.name}: no rule for type {field.dataType.simpleString()}")


def check_ledger_strict(df: DataFrame) -> DataFrame:
    """Add `errors` of the consumer profile to already typed rows."""
    return df.withColumn("errors", error_list(strict_rules()))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).drop("errors")


def error_rows(checked: DataFrame) -> DataFrame:
    """Quarantine: where each bad row came from and why."""
    return checked.filter(F.size("errors") > 0).select("source_key", "errors")


def ingest_counts(checked: DataFrame) -> DataFrame:
    """Files retrieved, ok and failed, and the share that was ok (0 when none)."""
    ok = F.count_if(F.size("errors") == 0)
    total = F.count(F.lit(1))
    return checked.agg(
        total.alias("files_retrieved"), ok.alias("files_ok"), (total - ok).alias("files_failed")
    ).withColumn(
        "success_rate",
        F.when(
            F.col("files_retrieved") > 0, F.col("files_ok") / F.col("files_retrieved")
        ).otherwise(F.lit(0.0)),
    )


# --- generic batches --------------------------------------------------------------


def batch_summary(checked: DataFrame) -> DataFrame:
    """Totals and success percentage of a checked batch (0.0 when empty)."""
    valid = F.count_if(F.size("errors") == 0)
    total = F.count(F.lit(1))
    return checked.agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        (total - valid).alias("invalid_records"),
    ).withColumn(
        "success_rate",
        F.when(
            F.col("total_records") > 0, F.col("valid_records") * 100 / F.col("total_records")
        ).otherwise(F.lit(0.0)),
    )


def batch_errors(checked: DataFrame, index: str) -> DataFrame:
    """One row per invalid record: its index and messages."""
    return checked.filter(F.size("errors") > 0).select(F.col(index).alias("index"), "errors")


def fail_fast(checked: DataFrame, index: str) -> DataFrame:
    """The records seen by a run that stops at its first invalid one."""
    first_bad = checked.agg(F.min(F.when(F.size("errors") > 0, F.col(index)))).scalar()
    return checked.filter(F.col(index) <= F.coalesce(first_bad, F.col(index)))


def required_field_errors(df: DataFrame, fields: Sequence[str]) -> Column:
    """Messages for missing columns, NULLs and blank text."""
    kinds = dict(df.dtypes)
    rules = []
    for f in fields:
        if f not in kinds:
            rules.append(Rule(MISSING_FIELD.format(field=f), F.lit(True)))
            continue
        rules.append(Rule(NULL_FIELD.format(field=f), F.col(f).isNull()))
        if kinds[f] == "string":
            blank = text.strip_whitespace(F.col(f)) == ""
            rules.append(Rule(BLANK_FIELD.format(field=f), blank))
    return error_list(rules)


def json_type_errors(value: Column, expected: Mapping[str, Sequence[str]]) -> Column:
    """Messages for fields of a JSON object whose type is not an expected one.

    Types are Spark's names for JSON values (STRING, BIGINT, DOUBLE, BOOLEAN, ...);
    DECIMAL covers every written fraction. Absent and null fields are skipped.
    """
    parsed = F.try_parse_json(value)
    messages = []
    for field, types in expected.items():
        actual = F.regexp_extract(
            json_type(F.try_variant_get(parsed, f"$.{field}", "variant")), r"^[A-Z]+", 0
        )
        wrong = ~actual.isin(*types, "VOID", "")
        messages.append(
            F.when(
                wrong,
                F.concat(
                    F.lit(WRONG_TYPE.format(field=field, expected=" or ".join(types))),
                    actual,
                ),
            )
        )
    return F.array_compact(F.array(*messages))


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per difference: missing and extra columns, then wrong types.

    affected_values counts the non-NULL values of an extra or wrongly typed column.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = [(c, "missing", wanted[c], None) for c in wanted if c not in actual]
    rows += [(c, "extra", None, actual[c]) for c in actual if c not in wanted]
    rows += [
        (c, "type", wanted[c], actual[c])
        for c in wanted
        if c in actual and actual[c] != wanted[c]
    ]
    if not rows:
        return df.sparkSession.createDataFrame(
            [],
            "column string, problem string, expected string, actual string, affected_values bigint",
        )
    values = [F.count(f"`{c}`") if c in actual else F.lit(0).cast("bigint") for c, *_ in rows]
    counted = df.agg(F.array(*values).alias("n"))
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(problem).alias("problem"),
                F.lit(want).cast("string").alias("expected"),
                F.lit(have).cast("string").alias("actual"),
                F.col("n")[i].alias("affected_values"),
            )
            for i, (c, problem, want, have) in enumerate(rows)
        ]
    )
    return counted.select(F.inline(lines))


class SchemaMismatch(ValueError):
    """A DataFrame does not have the columns or types that were declared."""


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The frame itself, or SchemaMismatch naming every difference."""
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in expected}
    problems = []
    if missing := sorted(wanted.keys() - actual.keys()):
        problems.append(f"missing columns: {missing}")
    if extra := sorted(actual.keys() - wanted.keys()):
        problems.append(f"extra columns: {extra}")
    for c in wanted:
        if c in actual and actual[c] != wanted[c]:
            problems.append(
                f"{c}: expected {wanted[c].simpleString()}, got {actual[c].simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df


def require_report_schema(df: DataFrame) -> bool:
    """True when the monthly-report queries can run on the frame."""
    usable = {
        "center_label": (T.StringType,),
        "action": (T.StringType,),
        "timestamp": (T.TimestampType, T.TimestampNTZType),
        "pipeline_adcid": (T.IntegerType, T.LongType),
    }
    actual = {f.name: f.dataType for f in df.schema}
    if missing := [c for c in usable if c not in actual]:
        raise SchemaMismatch(f"missing required columns: {missing}")
    for c, kinds in usable.items():
        if not isinstance(actual[c], kinds):
            raise SchemaMismatch(f"{c} has unusable type {actual[c].simpleString()}")
    return True


def conform(df: DataFrame, target: T.StructType = schema.LEDGER) -> DataFrame:
    """Exactly the target's columns, in order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in target])


# --- record profiles ------------------------------------------------------------------


def record_errors(id_col: Column, value_col: Column) -> Column:
    """Record rules: an id, and a value of zero or more."""
    return error_list(
        [
            Rule(RECORD_WITHOUT_ID, id_col.isNull() | (id_col == "")),
            Rule("value: field required", value_col.isNull()),
            Rule(RECORD_BELOW_ZERO, value_col < 0),
        ]
    )


def accept_records(df: DataFrame, id_col: str = "id", value_col: str = "value") -> DataFrame:
    """Records that pass the record rules, stamped with the processing time."""
    errors = record_errors(F.col(id_col), F.col(value_col))
    return df.filter(F.size(errors) == 0).withColumn("processed_at", F.current_timestamp())


def length_rule(name: str, col: Column, low: int, high: int) -> Rule:
    ok = (F.length(col) >= low) & (F.length(col) <= high)
    return Rule(f"{name}: length must be {low} to {high}", col.isNull() | ~ok)


def reporting_event_errors(source: Column, event_type: Column) -> Column:
    """Bounded-length rules of the generic reporting event."""
    return error_list(
        [length_rule("source", source, 1, 100), length_rule("event_type", event_type, 1, 50)]
    )
