"""Record validation, dead letters and the choice among candidate extractions.

The rules of a record type become one column: an array with a message for every rule broken. Types
are checked on the JSON as a variant, before any cast: a boolean is no number, 5.0 is an integer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import url_fingerprint
from recordmill.operators.audits import union_all
from recordmill.operators.dedup import pick_by
from recordmill.schemas import RECORD_RULES, Rule
from recordmill.session import cut_lineage


def _nodes(path: str, rule: Rule) -> list[tuple[str, Rule]]:
    """The rule and all rules below it, with their paths."""
    out = [(path, rule)]
    for name, below in rule.fields.items():
        out.extend(_nodes(f"{path}.{name}", below))
    return out


def _kind(text: Column, number: Column) -> Column:
    """JSON type name from the type text of a variant and its value as a number."""
    numeric = F.startswith(text, F.lit("DECIMAL")) | text.isin("DOUBLE", "FLOAT")
    return (
        F.when(text == "BIGINT", F.lit("integer"))
        .when(text == "STRING", F.lit("string"))
        .when(text == "BOOLEAN", F.lit("boolean"))
        .when(text == "VOID", F.lit("null"))
        .when(numeric & (number == F.floor(number)), F.lit("integer"))
        .when(numeric, F.lit("number"))
        .when(F.startswith(text, F.lit("OBJECT")), F.lit("object"))
        .when(F.startswith(text, F.lit("ARRAY")), F.lit("array"))
    )


def present_types(df: DataFrame, type_column: str = "record_type") -> list[str]:
    """The known record types among the rows: at most as many names as there are rule sets."""
    found = df.select(type_column).filter(F.col(type_column).isin(list(RECORD_RULES))).distinct()
    return [row[0] for row in found.collect()]


def _broken(n: dict[str, Column], rule: Rule, label: str, children: dict[str, Column]) -> list[Column]:
    """Messages for one value, null where its rule holds."""
    kind = n["kind"]

    def when(condition: Column, message: str) -> Column:
        return F.when(condition, F.lit(f"{label}: {message}"))

    accepted = [*rule.types, "integer"] if "number" in rule.types else list(rule.types)
    found = [when(~kind.isin(accepted), "type")]
    if rule.allowed is not None:
        # Enumerations hold for any JSON type, so a wrong type breaks this rule as well.
        inside = F.coalesce((kind == "string") & n["text"].isin(list(rule.allowed)), F.lit(False))
        found.append(when(kind.isNotNull() & ~inside, "allowed"))
    if rule.min_length is not None:
        found.append(when((kind == "string") & (F.length(n["text"]) < rule.min_length), "length"))
    if rule.minimum is not None:
        found.append(when(kind.isin("integer", "number") & (n["number"] < rule.minimum), "minimum"))
    if rule.maximum is not None:
        found.append(when(kind.isin("integer", "number") & (n["number"] > rule.maximum), "maximum"))
    if rule.items is not None:
        odd = F.exists(n["items"], lambda v: F.schema_of_variant(v) != rule.items.upper())
        found.append(when((kind == "array") & odd, "items"))
    if rule.fields:
        known = F.array(*[F.lit(name) for name in rule.fields])
        found.append(when((kind == "object") & (F.size(F.array_except(n["keys"], known)) > 0), "extra keys"))
    for name in rule.required:
        found.append(when((kind == "object") & children[name].isNull(), f"missing {name}"))
    return found


def validate(df: DataFrame, record_type: str, payload: str = "payload") -> DataFrame:
    """Adds ``errors``, a sorted array of messages, and ``valid``.

    The work is laid out in steps, each a projection over the one before: parse once, pick the
    values, name their types, check the rules. So nothing is parsed or looked up twice, and no
    single expression grows too large to be compiled."""
    rule = RECORD_RULES.get(record_type)
    if rule is None:
        message = F.array(F.lit(f"no schema registered for '{record_type}'"))
        return df.withColumn("errors", message).withColumn("valid", F.lit(False))
    nodes = _nodes("$", rule)
    index = {path: i for i, (path, _) in enumerate(nodes)}
    helpers = ["_root"]
    out = df.withColumn("_root", F.try_parse_json(F.col(payload)))

    def step(columns: dict[str, Column]) -> DataFrame:
        helpers.extend(columns)
        return out.withColumns(columns)

    root = F.col("_root")
    # Only single values are copied out of the record; of objects and lists no more than what a rule looks at.
    leaves = {index[path] for path, r in nodes if not r.fields and r.items is None}
    out = step({f"_v{i}": F.try_variant_get(root, path, "variant") for path, i in index.items() if i in leaves})
    picked: dict[str, Column] = {}
    for path, r in nodes:
        i = index[path]
        if r.allowed is not None or r.min_length is not None:
            picked[f"_s{i}"] = F.try_variant_get(root, path, "string")
        if {"integer", "number"} & set(r.types):
            picked[f"_n{i}"] = F.try_variant_get(root, path, "double")
        if r.items is not None:
            picked[f"_a{i}"] = F.try_variant_get(root, path, "array<variant>")
        if r.fields:
            picked[f"_o{i}"] = F.map_keys(F.try_variant_get(root, path, "map<string,variant>"))
        if i in leaves:
            picked[f"_t{i}"] = F.schema_of_variant(F.col(f"_v{i}"))
    out = step(picked)

    def kind_of(path: str, i: int) -> Column:
        value = F.col(f"_v{i}") if i in leaves else F.try_variant_get(root, path, "variant")
        number = F.col(f"_n{i}") if f"_n{i}" in picked else F.try_variant_get(value, "$", "double")
        # Naming the type of an object or a list means walking through all of it, so these are told
        # by what was picked, and named only where that failed.
        if f"_o{i}" in picked:
            other = _kind(F.schema_of_variant(value), number)
            return F.when(F.col(f"_o{i}").isNotNull(), F.lit("object")).otherwise(other)
        if f"_a{i}" in picked:
            other = _kind(F.schema_of_variant(value), number)
            return F.when(F.col(f"_a{i}").isNotNull(), F.lit("array")).otherwise(other)
        return _kind(F.col(f"_t{i}"), number)

    out = step({f"_k{i}": kind_of(path, i) for path, i in index.items()})
    messages = []
    for path, r in nodes:
        i = index[path]
        parts = {
            "kind": F.col(f"_k{i}"), "text": F.col(f"_s{i}"), "number": F.col(f"_n{i}"),
            "items": F.col(f"_a{i}"), "keys": F.col(f"_o{i}"),
        }
        children = {name: F.col(f"_k{index[f'{path}.{name}']}") for name in r.required}
        messages.extend(_broken(parts, r, path.lstrip("$").lstrip(".") or "record", children))
    # Set difference and sort_array are compiled; array_compact and array_sort would be interpreted,
    # and every rule inside them with it.
    found = F.sort_array(
        F.array_except(F.array(*messages), F.array(F.lit(None).cast("string")))
    )
    errors = F.when(root.isNull(), F.array(F.lit("record: not JSON"))).otherwise(found)
    return out.withColumn("errors", errors).drop(*helpers).withColumn("valid", F.size("errors") == 0)


def validate_by_type(
    df: DataFrame, type_column: str = "record_type", payload: str = "payload",
    types: list[str] | None = None,
) -> DataFrame:
    """As :func:`validate`, with the record type taken from a column. Each type's rules see only
    the rows of that type; rows of a type without rules are invalid. ``types`` names the types
    that occur, where the caller knows that the others do not."""
    kind = F.col(type_column)
    wanted = list(RECORD_RULES) if types is None else types
    parts = [validate(df.filter(kind == name), name, payload) for name in wanted]
    unknown = F.array(
        F.concat(F.lit("no schema registered for '"), F.coalesce(kind, F.lit("")), F.lit("'"))
    )
    rest = df.filter(~F.coalesce(kind.isin(list(RECORD_RULES)), F.lit(False)))
    parts.append(rest.withColumn("errors", unknown).withColumn("valid", F.lit(False)))
    return union_all(parts)


def validate_or_fail(df: DataFrame, record_type: str, payload: str = "payload") -> DataFrame:
    """Strict mode: the job stops at the first invalid row."""
    checked = validate(df, record_type, payload)
    message = F.concat(F.lit(f"{record_type} rejected: "), F.array_join("errors", "; "))
    return checked.withColumn("valid", F.when(F.col("valid"), True).otherwise(F.raise_error(message)))


def dead_letters(
    rejected: DataFrame, category: Column, component: Column, message: Column, attempts: int = 3,
    enqueued_at: Column | None = None,
) -> DataFrame:
    """Dead-letter rows with the payload, where there is one, for a replay. The id follows from the
    row, so a rerun writes the same ids."""
    key = F.concat_ws("|", url_fingerprint(F.col("url")), F.col("seq").cast("string"), category)
    return rejected.select(
        F.concat(F.lit("dlq_"), F.substring(F.sha2(key, 256), 1, 32)).alias("dlq_id"),
        "seq",
        F.col("url").alias("source_url"),
        category.alias("error_category"),
        message.alias("error_message"),
        component.alias("failed_component"),
        F.substring("raw_content", 1, 200).alias("preview"),
        _given(rejected, "payload").alias("payload_json"),
        F.lit(attempts).cast("bigint").alias("attempts"),
        (F.lit(None).cast("string") if enqueued_at is None else enqueued_at).alias("enqueued_at"),
    )


def _given(df: DataFrame, name: str) -> Column:
    """A text column where the frame has it, else null."""
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validated rows as records and dead letters. ``checked`` must be materialised: a filter on
    ``valid`` would otherwise be pushed below the checks and carry all of them with it, twice."""
    bad = dead_letters(
        checked.filter("NOT valid"),
        F.lit("EXTRACTION_OR_VALIDATION_FAILED"), F.lit("ExtractionLayer"),
        F.array_join("errors", "; "),
    )
    return checked.filter("valid"), bad


def route(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As :func:`split_valid`, writing the validated rows to the shared folder first."""
    return split_valid(cut_lineage(checked, "checked"))


def pipeline_status(
    duplicate: Column, fetched: Column, needs_gate: Column, gate_status: Column, extracted: Column,
    valid: Column,
) -> Column:
    """Final status of a record; steps are checked in the order the pipeline takes them."""
    return (
        F.when(duplicate, F.lit("DUPLICATE_ALREADY_PROCESSED"))
        .when(~fetched, F.lit("FETCH_FAILED"))
        .when(needs_gate & (gate_status != "FRESH"), F.lit("FRESHNESS_REJECTED"))
        .when(~extracted, F.lit("EXTRACTION_FAILED"))
        .when(~valid, F.lit("VALIDATION_FAILED"))
        .otherwise(F.lit("NEW_RECORD_STORED"))
    )


def first_valid_candidate(
    candidates: DataFrame, record_type: str
) -> tuple[DataFrame, DataFrame]:
    """Per record the lowest tier whose candidate parses and validates, and the records for which
    no tier does. Payloads stay out of the aggregate: one valid row per record and task is shuffled."""
    checked = validate(candidates, record_type)
    chosen = pick_by(
        checked.filter("valid").select("record_id", "tier", "payload"), ["record_id"], "tier", newest=False)
    tried = checked.groupBy("record_id").agg(F.max("valid").alias("found"), F.count(F.lit(1)).alias("tiers_tried"))
    return chosen, tried.filter(~F.col("found")).select("record_id", "tiers_tried")
