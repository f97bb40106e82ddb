"""Entity resolution: ordered tiers of lookups, the first hit decides.

The master table is turned into lookup tables with one row per key. Records meet them by equi-join
only. Even the substring rule of the composite tier is one: the domains of unresolved records are
taken apart into substrings, and these are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.fixed_values import NEW_ENTITY_REASON, DISTINGUISHING_WORDS, SEED_ENTITIES
from recordmill.functions.names import (
    entity_id,
    jaro_winkler,
    normalize_domain,
    normalize_entity,
    title_case,
)
from recordmill.functions.text import blank_to_null, strip
from recordmill.operators.audits import union_all
from recordmill.operators.upsert import upsert_entities
from recordmill.session import BROADCAST_BYTES, cut_lineage, join_side

RESOLVER_VERSION = "1.0.0"
_ENTITY = ["canonical_entity_id", "canonical_name"]


def seed_master(spark: SparkSession) -> DataFrame:
    """The built-in master table."""
    rows = [(i, *entity) for i, entity in enumerate(SEED_ENTITIES)]
    seeds = spark.createDataFrame(
        rows,
        "seq bigint, entity_type string, canonical_name string, normalized_name string, "
        "aliases array<string>, domains array<string>, external_ids map<string,string>, "
        "source_urls array<string>",
    ).coalesce(1)
    stamp = F.lit("2026-01-01T00:00:00Z").cast("timestamp")
    return seeds.select(
        "seq", entity_id(F.col("entity_type"), F.col("canonical_name")).alias("canonical_entity_id"),
        "entity_type", "canonical_name", "normalized_name", "aliases", "domains", "external_ids",
        "source_urls", stamp.alias("created_at"), stamp.alias("updated_at"),
    )


def lookup_tables(master: DataFrame) -> dict[str, DataFrame]:
    """``external``, ``domain``, ``name`` and ``alias`` lookups, one row per key. When entities claim
    the same key, the last one in master order has it.

    All four are made in one aggregation and written once. Each is then measured by itself and
    broadcast only if it is small (see :func:`recordmill.session.join_side`)."""
    none = F.lit("").alias("scope")
    base = ["seq", *_ENTITY]
    external = master.select(*base, F.explode("external_ids").alias("k", "v")).filter(
        F.coalesce(F.col("v"), F.lit("")) != ""
    ).select(*base, F.lower(strip(F.col("k"))).alias("scope"), F.lower(strip(F.col("v"))).alias("key"))
    domain = master.select(*base, F.explode("domains").alias("d")).select(
        *base, none, normalize_domain(F.col("d")).alias("key")
    ).filter("key <> ''")
    scopes = F.explode(F.array(F.upper("entity_type"), F.lit("ANY"))).alias("scope")
    name = master.select(*base, scopes, normalize_entity(F.col("canonical_name")).alias("key"))
    alias = master.select(*base, "entity_type", F.explode("aliases").alias("a")).select(
        *base, scopes, normalize_entity(F.col("a")).alias("key")
    ).filter("key <> ''")
    parts = {"external": external, "domain": domain, "name": name, "alias": alias}
    rows = union_all([df.withColumn("kind", F.lit(kind)) for kind, df in parts.items()])
    size = F.octet_length(F.to_json(F.struct("scope", "key", "entity")))
    table = cut_lineage(
        rows.groupBy("kind", "scope", "key").agg(
            F.max_by(F.struct(*_ENTITY), F.col("seq")).alias("entity")
        ),
        "lookups",
    )
    bytes_of = {r[0]: r[1] for r in table.groupBy("kind").agg(F.sum(size)).collect()}
    names = {
        "external": {"scope": "id_kind", "key": "id_value"}, "domain": {"key": "domain"},
        "name": {"key": "name"}, "alias": {"key": "name"},
    }

    def lookup(kind: str) -> DataFrame:
        mine = table.filter(F.col("kind") == kind).drop("kind")
        mine = mine.drop("scope") if kind == "domain" else mine
        mine = mine.withColumnsRenamed(names[kind])
        return F.broadcast(mine) if bytes_of.get(kind, 0) <= BROADCAST_BYTES else mine

    return {kind: lookup(kind) for kind in parts}


def prepare(records: DataFrame) -> DataFrame:
    """Records (``seq, raw_name, entity_type, domain, external_ids``) with their normal forms."""
    return (
        records.withColumn("raw_value", strip(F.coalesce(F.col("raw_name"), F.lit(""))))
        .withColumn("normalized_value", normalize_entity(F.col("raw_value")))
        .withColumn("norm_type", F.upper(strip(F.col("entity_type"))))
        .withColumn("norm_domain", normalize_domain(F.col("domain")))
    )


def external_id_pairs(records: DataFrame) -> DataFrame:
    """``(seq, pos, id_kind, id_value, given_kind, given_value)``, blanks left out."""
    pairs = records.select(
        "seq", F.posexplode(F.map_entries("external_ids")).alias("pos", "e")
    ).filter(F.coalesce(F.col("e.value"), F.lit("")) != "")
    return pairs.select(
        "seq", "pos",
        F.lower(strip(F.col("e.key"))).alias("id_kind"),
        F.lower(strip(F.col("e.value"))).alias("id_value"),
        F.col("e.key").alias("given_kind"), F.col("e.value").alias("given_value"),
    )


def external_hits(prepared: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """First external id, in the order given, that the master knows."""
    found = external_id_pairs(prepared).join(lookups["external"], ["id_kind", "id_value"])
    return found.groupBy("seq").agg(
        F.min_by(F.struct("entity", "given_kind", "given_value"), "pos").alias("by_id")
    )


def _named(table: DataFrame, scope: str | None, out: str) -> DataFrame:
    # The hint of a broadcast table survives the projections made here.
    rows = table if scope is None else table.filter(F.col("scope") == scope).drop("scope")
    return rows.withColumnRenamed("entity", out)


def exact_hits(prepared: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Adds ``by_domain``, ``by_name`` and ``by_alias``. A record's own type goes before ANY."""
    out = prepared.join(
        lookups["domain"].withColumnsRenamed({"domain": "norm_domain", "entity": "by_domain"}),
        "norm_domain", "left",
    )
    for kind in ("name", "alias"):
        own = _named(lookups[kind], None, "own").withColumnsRenamed(
            {"scope": "norm_type", "name": "normalized_value"}
        )
        any_type = _named(lookups[kind], "ANY", "any").withColumnRenamed("name", "normalized_value")
        out = (
            out.join(own, ["norm_type", "normalized_value"], "left")
            .join(any_type, "normalized_value", "left")
            .withColumn(f"by_{kind}", F.coalesce("own", "any"))
            .drop("own", "any")
        )
    return out


def _substrings(c: Column, shortest: int, longest: int) -> Column:
    """Distinct substrings with lengths in the range."""
    last = F.length(c) - shortest + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    from_start = F.transform(
        starts,
        lambda i: F.transform(
            F.sequence(F.lit(shortest), F.least(F.lit(longest), F.length(c) - i + 1)),
            lambda n: F.substr(c, i, n),
        ),
    )
    return F.array_distinct(F.flatten(from_start))


def composite_hits(residual: DataFrame, master: DataFrame) -> DataFrame:
    """First master row, in order, whose name contains or is contained in the record's name, with
    no distinguishing word between the two, and one of whose domains occurs in the record's domain.

    Works on distinct (name, domain) pairs. Each distinct domain is taken apart once."""
    wanted = residual.filter("norm_domain <> ''").select("normalized_value", "norm_domain").distinct()
    claims = master.select(
        F.col("seq").alias("master_seq"), *_ENTITY, "normalized_name", F.explode("domains").alias("part")
    ).filter("part <> ''")
    claimed = join_side(claims, "domain-claims")
    shortest, longest = claimed.agg(F.min(F.length("part")), F.max(F.length("part"))).first()
    candidates = (
        wanted.select("norm_domain").distinct()
        .select("norm_domain", F.explode(_substrings(F.col("norm_domain"), shortest or 1, longest or 1)).alias("part"))
        .join(claimed, "part")
        .drop("part")
        .distinct()
    )
    mine = F.split("normalized_value", " ")
    theirs = F.split("normalized_name", " ")
    differing = F.concat(F.array_except(mine, theirs), F.array_except(theirs, mine))
    special = F.array(*[F.lit(w) for w in DISTINGUISHING_WORDS])
    overlap = F.contains("normalized_value", "normalized_name") | F.contains(
        "normalized_name", "normalized_value"
    )
    return (
        wanted.join(candidates, "norm_domain")
        .filter(overlap & ~F.arrays_overlap(differing, special))
        .groupBy("normalized_value", "norm_domain")
        .agg(F.min_by(F.struct(*_ENTITY), F.col("master_seq")).alias("by_parts"))
    )


def _letters(c: Column) -> Column:
    """Letters numbered by their occurrence (``a1, a2``): equal ones can be paired off."""
    chars = F.filter(F.split(c, ""), lambda ch: ch != "")
    numbered = F.transform(
        chars,
        lambda ch, i: F.concat(
            F.lpad(
                F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == ch)).cast("string"), 4, "0"
            ),
            ch,
        ),
    )
    return F.reverse(F.array_sort(numbered))


def fuzzy_hits(residual: DataFrame, master: DataFrame, threshold: float = 0.92) -> DataFrame:
    """Closest master name by Jaro-Winkler, if at least ``threshold``. Off unless asked for.

    Exact without comparing everybody. With the largest prefix bonus, a score ``w`` needs a plain
    Jaro score of ``(w - 0.4) / 0.6``, hence ``m/a + m/b >= 3 * that - 1``; as ``m`` is at most
    either length, both ``m/a`` and ``m/b`` reach that bound less one. So two names share a known
    fraction of their letters, and when each name's letters are put in one fixed order, the leading
    letters that remain after taking off this share must meet. Names join on those."""
    share = max(3 * (threshold - 0.4) / 0.6 - 2, 0.0)

    def keyed(df: DataFrame, name: str, *rest: str) -> DataFrame:
        lead = F.length(name) - F.ceil(F.length(name) * F.lit(share - 1e-9)) + 1
        return df.select(
            name, *rest, F.explode(F.slice(_letters(F.col(name)), F.lit(1), lead.cast("int"))).alias("letter")
        )

    names = residual.select("normalized_value").filter("normalized_value <> ''").distinct()
    seeds = master.select(
        F.col("seq").alias("master_seq"), *_ENTITY, "normalized_name"
    ).filter("normalized_name <> ''")
    pairs = (
        keyed(names, "normalized_value")
        .join(keyed(seeds, "normalized_name", "master_seq", *_ENTITY), "letter")
        .filter(
            (F.length("normalized_value") * share <= F.length("normalized_name"))
            & (F.length("normalized_name") * share <= F.length("normalized_value"))
        )
        .drop("letter")
        .distinct()
    )
    scored = pairs.withColumn(
        "score", jaro_winkler(F.col("normalized_value"), F.col("normalized_name"))
    ).filter(F.col("score") >= threshold)
    return scored.groupBy("normalized_value").agg(
        F.min_by(
            F.struct(*_ENTITY, "score"), F.struct(-F.col("score"), F.col("master_seq"))
        ).alias("by_score")
    )


def resolve_all(records: DataFrame, master: DataFrame, fuzzy: bool = False) -> DataFrame:
    """Adds ``raw_value, normalized_value, canonical_value, canonical_entity_id, decision,
    match_method, confidence, evidence`` to every record.

    The hits of the two costlier tiers are worked out on distinct names and domains first. As long
    as the lookups and these hits are small, records pass through without any shuffle."""
    lookups = lookup_tables(master)
    prepared = prepare(records)
    by_id = join_side(external_hits(prepared, lookups), "external-hits")
    exact = exact_hits(prepared, lookups).join(by_id, "seq", "left")
    open_rows = F.coalesce(
        F.col("by_id.entity"), F.col("by_domain"), F.col("by_name"), F.col("by_alias")
    ).isNull()
    residual = exact.filter(open_rows & (F.col("raw_value") != ""))
    by_parts = join_side(composite_hits(residual, master), "composite-hits")
    tiers = exact.join(by_parts, ["normalized_value", "norm_domain"], "left")
    if fuzzy:
        by_name = join_side(fuzzy_hits(residual, master), "fuzzy-hits")
        tiers = tiers.join(by_name, "normalized_value", "left")
        by_score = F.when(open_rows & F.col("by_parts").isNull(), F.col("by_score"))
    else:
        by_score = F.lit(None).cast("struct<canonical_entity_id:string,canonical_name:string,score:double>")
    tiers = tiers.withColumn("by_parts", F.when(open_rows, F.col("by_parts"))).withColumn(
        "by_score", by_score
    )
    return _decide(tiers).select(
        *records.columns, "raw_value", "normalized_value", "canonical_value", "canonical_entity_id",
        "decision", "match_method", "confidence", "evidence",
    )


def _decide(tiers: DataFrame) -> DataFrame:
    empty = F.col("raw_value") == ""
    new_name = F.coalesce(
        blank_to_null(title_case(F.col("normalized_value"))), F.col("raw_value")
    )
    ladder = [
        # condition, name, id, decision, method, confidence, evidence
        (empty, F.lit("Unknown Entity"), F.lit(None).cast("string"), "NO_MATCH",
         F.lit("EMPTY_INPUT"), 0.0, {"empty_input": F.lit("true")}),
        (F.col("by_id").isNotNull(), F.col("by_id.entity.canonical_name"),
         F.col("by_id.entity.canonical_entity_id"), "EXACT_EXTERNAL_ID_MATCH",
         F.concat(F.lit("EXTERNAL_ID_"), F.upper("by_id.given_kind")), 1.0,
         {"external_id_type": F.col("by_id.given_kind"),
          "external_id_value": F.col("by_id.given_value")}),
        (F.col("by_domain").isNotNull(), F.col("by_domain.canonical_name"),
         F.col("by_domain.canonical_entity_id"), "DOMAIN_MATCH", F.lit("EXACT_DOMAIN_MATCH"), 1.0,
         {"domain": F.col("norm_domain")}),
        (F.col("by_name").isNotNull(), F.col("by_name.canonical_name"),
         F.col("by_name.canonical_entity_id"), "EXACT_NAME_MATCH", F.lit("EXACT_NAME_MATCH"), 1.0,
         {"normalized_name": F.col("normalized_value")}),
        (F.col("by_alias").isNotNull(), F.col("by_alias.canonical_name"),
         F.col("by_alias.canonical_entity_id"), "ALIAS_MATCH", F.lit("ALIAS_EXACT_MATCH"), 1.0,
         {"alias_matched": F.col("normalized_value")}),
        (F.col("by_parts").isNotNull(), F.col("by_parts.canonical_name"),
         F.col("by_parts.canonical_entity_id"), "COMPOSITE_MATCH", F.lit("COMPOSITE_EVIDENCE"), 0.95,
         {"name_overlap": F.lit("true"), "domain_overlap": F.lit("true")}),
        (F.col("by_score").isNotNull(), F.col("by_score.canonical_name"),
         F.col("by_score.canonical_entity_id"), "FUZZY", F.lit("FUZZY_JARO_WINKLER"), 0.95,
         {"similarity": F.round("by_score.score", 4).cast("string")}),
        (F.lit(True), new_name, entity_id(F.col("norm_type"), new_name), "CREATE_NEW_CANONICAL",
         F.lit("CREATE_NEW_CANONICAL_ENTITY"), 0.80,
         {"existing_match_found": F.lit("false"), "created_new_canonical": F.lit("true"), "reason": F.lit(NEW_ENTITY_REASON)}),
    ]

    def choose(pick) -> Column:
        out = None
        for step in ladder:
            value = pick(step)
            out = F.when(step[0], value) if out is None else out.when(step[0], value)
        return out

    def evidence(step) -> Column:
        entries = [x for k, v in step[6].items() for x in (F.lit(k), v)]
        if step[3] not in ("NO_MATCH", "CREATE_NEW_CANONICAL"):
            entries += [F.lit("matched_canonical_id"), step[2]]
        return F.create_map(*entries)

    return tiers.select(
        "*",
        choose(lambda s: s[1]).alias("canonical_value"),
        choose(lambda s: s[2]).alias("canonical_entity_id"),
        choose(lambda s: F.lit(s[3])).alias("decision"),
        choose(lambda s: s[4]).alias("match_method"),
        choose(lambda s: F.lit(s[5])).alias("confidence"),
        choose(evidence).alias("evidence"),
    )


def mapping_log(resolved: DataFrame, source_url: Column, at: Column) -> DataFrame:
    """Audit rows. The id follows from URL, name and type, so a rerun writes the same rows."""
    key = F.concat_ws("|", F.coalesce(source_url, F.lit("")), "raw_value", "entity_type")
    return resolved.select(
        "seq",
        F.concat(F.lit("map_"), F.substring(F.sha2(key, 256), 1, 32)).alias("mapping_id"),
        F.lit("1.0").alias("schema_version"),
        "entity_type", "raw_value", "normalized_value", "canonical_value",
        F.col("canonical_entity_id").alias("resolved_canonical_entity_id"),
        "decision", "match_method", "confidence", "evidence",
        at.alias("timestamp"), source_url.alias("source_url"),
        F.lit(RESOLVER_VERSION).alias("resolver_version"),
    )


def entity_name(record_type: Column, content: dict[str, Column]) -> Column:
    """The name to resolve, which depends on the record type."""
    chosen = {
        "STARTUP": "entityName", "PRODUCT": "startupName", "JOB": "company",
        "RESEARCH_PAPER": "title", "NEWS": "publisher",
    }
    out = F.lit(None).cast("string")
    for kind, name in chosen.items():
        out = F.when(record_type == kind, content[name]).otherwise(out)
    return F.coalesce(out, F.lit(""))


def write_back(record_type: Column, given: Column, canonical: Column) -> Column:
    """Startups, products and jobs take the canonical name over; the others keep their own text."""
    return F.when(record_type.isin("STARTUP", "PRODUCT", "JOB"), canonical).otherwise(given)


def register_entities(master: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Next master: known ids are replaced in place, new ones follow at the end of the order."""
    return upsert_entities(master, arrivals)
