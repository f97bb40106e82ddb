"""Queries over entity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.catalog.base import FRAMES, Tables, on, query
from recordmill.catalog.texts import sql_capitalised, sql_domain, sql_entity, sql_entity_id
from recordmill.fixed_values import NEW_ENTITY_REASON, DISTINGUISHING_WORDS, SEED_ENTITIES
from recordmill.functions.names import normalize_entity
from recordmill.operators import resolve as R
from recordmill.catalog.history import customer_master, master_arrivals


def _values(rows: list[tuple]) -> str:
    return ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows
    )


_NAMES = [(i, s[1], s[2]) for i, s in enumerate(SEED_ENTITIES)]
_ALIASES = [(i, a) for i, s in enumerate(SEED_ENTITIES) for a in s[3]]
_DOMAINS = [(i, d) for i, s in enumerate(SEED_ENTITIES) for d in s[4]]
_IDS = [(i, k, v) for i, s in enumerate(SEED_ENTITIES) for k, v in s[5].items()]
_SPECIAL = "[" + ", ".join(f"'{w}'" for w in DISTINGUISHING_WORDS) + "]"

SQL_SEEDS = f"""seeds AS (SELECT * FROM (VALUES {_values(_NAMES)}) v(pos, name, norm)),
    s AS (SELECT pos, name, norm, {sql_entity_id("'STARTUP'", 'name')} AS id FROM seeds),
    s_name AS (SELECT {sql_entity('name')} AS k, arg_max(pos, pos) AS pos FROM s GROUP BY 1),
    s_alias AS (SELECT {sql_entity('a')} AS k, arg_max(pos, pos) AS pos FROM (VALUES {_values(_ALIASES)}) v(pos, a) GROUP BY 1),
    s_domain AS (SELECT {sql_domain('d')} AS k, arg_max(pos, pos) AS pos FROM (VALUES {_values(_DOMAINS)}) v(pos, d) GROUP BY 1),
    s_id AS (SELECT lower(v) AS k, arg_max(pos, pos) AS pos FROM (VALUES {_values(_IDS)}) x(pos, kind, v) WHERE kind = 'crunchbase' GROUP BY 1)"""

SQL_TIERS = f"""{SQL_SEEDS},
    r AS (SELECT *, trim(raw_name) AS raw_value, {sql_entity('raw_name')} AS nv, {sql_domain('domain')} AS nd, lower(trim(crunchbase)) AS cb FROM f),
    parts AS (SELECT r.seq, min(s.pos) AS pos FROM r JOIN s ON contains(nv, norm) OR contains(norm, nv)
      JOIN (VALUES {_values(_DOMAINS)}) v(dpos, d) ON dpos = s.pos AND nd <> '' AND contains(nd, d)
      WHERE NOT list_has_any(list_filter(string_split(nv, ' ') || string_split(norm, ' '),
        lambda w: NOT (list_contains(string_split(nv, ' '), w) AND list_contains(string_split(norm, ' '), w))), {_SPECIAL}) GROUP BY r.seq),
    tiers AS (SELECT r.*, i.pos AS by_id, d.pos AS by_domain, n.pos AS by_name, a.pos AS by_alias, p.pos AS by_parts FROM r
      LEFT JOIN s_id i ON i.k = cb LEFT JOIN s_domain d ON d.k = nd LEFT JOIN s_name n ON n.k = nv LEFT JOIN s_alias a ON a.k = nv LEFT JOIN parts p ON p.seq = r.seq),
    decided AS (SELECT *, CASE WHEN raw_value = '' THEN 'NO_MATCH' WHEN by_id IS NOT NULL THEN 'EXACT_EXTERNAL_ID_MATCH' WHEN by_domain IS NOT NULL THEN 'DOMAIN_MATCH'
        WHEN by_name IS NOT NULL THEN 'EXACT_NAME_MATCH' WHEN by_alias IS NOT NULL THEN 'ALIAS_MATCH' WHEN by_parts IS NOT NULL THEN 'COMPOSITE_MATCH' ELSE 'CREATE_NEW_CANONICAL' END AS decision,
      coalesce(by_id, by_domain, by_name, by_alias, by_parts) AS pos FROM tiers),
    resolved AS (SELECT t.seq, raw_value, nv AS normalized_value, decision,
      CASE WHEN decision = 'NO_MATCH' THEN 'Unknown Entity' WHEN decision = 'CREATE_NEW_CANONICAL' THEN coalesce(nullif({sql_capitalised('nv')}, ''), raw_value) ELSE s.name END AS canonical_value,
      CASE WHEN decision = 'NO_MATCH' THEN NULL WHEN decision = 'CREATE_NEW_CANONICAL' THEN {sql_entity_id('entity_type', f"coalesce(nullif({sql_capitalised('nv')}, ''), raw_value)")} ELSE s.id END AS canonical_entity_id,
      CASE decision WHEN 'NO_MATCH' THEN 'EMPTY_INPUT' WHEN 'EXACT_EXTERNAL_ID_MATCH' THEN 'EXTERNAL_ID_CRUNCHBASE' WHEN 'DOMAIN_MATCH' THEN 'EXACT_DOMAIN_MATCH'
        WHEN 'EXACT_NAME_MATCH' THEN 'EXACT_NAME_MATCH' WHEN 'ALIAS_MATCH' THEN 'ALIAS_EXACT_MATCH' WHEN 'COMPOSITE_MATCH' THEN 'COMPOSITE_EVIDENCE' ELSE 'CREATE_NEW_CANONICAL_ENTITY' END AS match_method,
      CASE decision WHEN 'NO_MATCH' THEN 0.0 WHEN 'COMPOSITE_MATCH' THEN 0.95 WHEN 'CREATE_NEW_CANONICAL' THEN 0.8 ELSE 1.0 END AS confidence
      FROM decided t LEFT JOIN s ON s.pos = t.pos)"""


def on_tiers(sql: str) -> str:
    return on("raw_names", f", {SQL_TIERS} {sql}")


def records(t: Tables) -> DataFrame:
    ids = F.when(F.col("crunchbase").isNotNull(), F.create_map(F.lit("crunchbase"), F.col("crunchbase")))
    return t.frame("raw_names").select("seq", "raw_name", "entity_type", "domain", ids.alias("external_ids"))


def resolved(t: Tables) -> DataFrame:
    return R.resolve_all(records(t), R.seed_master(t.spark))


_RESULT = ["seq", "raw_value", "normalized_value", "canonical_value", "canonical_entity_id", "decision", "match_method"]


@query("resolve_all", on_tiers(f"SELECT {', '.join(_RESULT)}, CAST(confidence AS DOUBLE) AS confidence FROM resolved"))
def _(t: Tables):
    return resolved(t).select(*_RESULT, "confidence")


def _tier(name: str, decision: str) -> None:
    @query(name, on_tiers(f"SELECT seq, canonical_value, canonical_entity_id FROM resolved WHERE decision = '{decision}'"))
    def _(t: Tables):
        return resolved(t).filter(F.col("decision") == decision).select("seq", "canonical_value", "canonical_entity_id")


for _name, _decision in (
    ("resolve_empty", "NO_MATCH"), ("resolve_composite", "COMPOSITE_MATCH"), ("resolve_new", "CREATE_NEW_CANONICAL"),
):
    _tier(_name, _decision)


@query("resolve_external_id", on_tiers("SELECT seq, s.name AS canonical_value, 'crunchbase' AS id_kind FROM tiers JOIN s ON s.pos = by_id"))
def _(t: Tables):
    hits = R.external_hits(records(t), R.lookup_tables(R.seed_master(t.spark)))
    return hits.select("seq", F.col("by_id.entity.canonical_name").alias("canonical_value"), F.col("by_id.given_kind").alias("id_kind"))


def _exact(t: Tables) -> DataFrame:
    return R.exact_hits(R.prepare(records(t)), R.lookup_tables(R.seed_master(t.spark)))


for _name, _hit in (("resolve_domain", "by_domain"), ("resolve_name", "by_name"), ("resolve_alias", "by_alias")):
    def _add(name: str, hit: str) -> None:
        @query(name, on_tiers(f"SELECT seq, s.name AS canonical_value, s.id AS canonical_entity_id FROM tiers JOIN s ON s.pos = {hit}"))
        def _(t: Tables):
            found = _exact(t).filter(F.col(hit).isNotNull())
            return found.select("seq", F.col(f"{hit}.canonical_name").alias("canonical_value"), F.col(f"{hit}.canonical_entity_id").alias("canonical_entity_id"))

    _add(_name, _hit)


@query("resolve_lookup", on_tiers("""SELECT t.seq, d.name AS by_domain, n.name AS by_name, a.name AS by_alias FROM tiers t
    LEFT JOIN s d ON d.pos = by_domain LEFT JOIN s n ON n.pos = by_name LEFT JOIN s a ON a.pos = by_alias"""))
def _(t: Tables):
    return _exact(t).select("seq", *[F.col(f"{h}.canonical_name").alias(h) for h in ("by_domain", "by_name", "by_alias")])


_SPELLED = "CASE WHEN seq % 3 = 0 THEN raw_name || 'i' WHEN seq % 3 = 1 THEN raw_name || ' x' ELSE replace(raw_name, 'n', 'm') END"


@query("resolve_fuzzy", on("raw_names", f""", {SQL_SEEDS},
    n AS (SELECT DISTINCT {sql_entity(_SPELLED)} AS normalized_value FROM f)
    SELECT normalized_value, name AS canonical_name, round(jaro_winkler_similarity(normalized_value, norm), 6) AS score FROM n, s
    WHERE normalized_value <> '' AND jaro_winkler_similarity(normalized_value, norm) >= 0.92
    QUALIFY row_number() OVER (PARTITION BY normalized_value ORDER BY jaro_winkler_similarity(normalized_value, norm) DESC, pos) = 1"""))
def _(t: Tables):
    spelled = normalize_entity(F.expr(_SPELLED))
    wanted = t.frame("raw_names").select(spelled.alias("normalized_value"))
    return R.fuzzy_hits(wanted, R.seed_master(t.spark)).select(
        "normalized_value", "by_score.canonical_name", F.round("by_score.score", 6).alias("score")
    )


@query("mapping_log", on_tiers(f"""SELECT 'map_' || substr(sha256(concat_ws('|', 'https://r.example.org/' || CAST(seq AS STRING), raw_value, 'STARTUP')), 1, 32) AS mapping_id,
    seq, '1.0' AS schema_version, 'STARTUP' AS entity_type, raw_value, normalized_value, canonical_value, canonical_entity_id AS resolved_canonical_entity_id,
    decision, match_method, CAST(confidence AS DOUBLE) AS confidence, '2026-01-01T00:00:00Z' AS timestamp, 'https://r.example.org/' || CAST(seq AS STRING) AS source_url,
    '1.0.0' AS resolver_version, CASE WHEN decision NOT IN ('NO_MATCH', 'CREATE_NEW_CANONICAL') THEN canonical_entity_id END AS matched,
    CASE WHEN decision = 'CREATE_NEW_CANONICAL' THEN '{NEW_ENTITY_REASON}' END AS reason FROM resolved"""))
def _(t: Tables):
    url = F.concat(F.lit("https://r.example.org/"), F.col("seq").cast("string"))
    log = R.mapping_log(resolved(t), url, F.lit("2026-01-01T00:00:00Z"))
    evidence = F.col("evidence")
    return log.withColumns({
        "matched": evidence["matched_canonical_id"],
        "reason": F.when(F.col("decision") == "CREATE_NEW_CANONICAL", evidence["reason"]),
    }).drop("evidence")


_KINDS = """CASE doc_id % 6 WHEN 0 THEN 'STARTUP' WHEN 1 THEN 'PRODUCT' WHEN 2 THEN 'JOB' WHEN 3 THEN 'RESEARCH_PAPER' WHEN 4 THEN 'NEWS' ELSE 'OTHER' END"""
_CONTENT = {"entityName": "'E ' || source", "startupName": "'S ' || source", "company": "'C ' || lang", "title": "'T ' || source", "publisher": "CASE WHEN doc_id % 4 = 0 THEN 'P ' || lang END"}
_SQL_ENTITY = f"""CASE doc_id % 6 WHEN 0 THEN {_CONTENT['entityName']} WHEN 1 THEN {_CONTENT['startupName']} WHEN 2 THEN {_CONTENT['company']} WHEN 3 THEN {_CONTENT['title']}
    WHEN 4 THEN coalesce({_CONTENT['publisher']}, '') ELSE '' END"""


@query("entity_name_by_type", f"SELECT doc_id, {_SQL_ENTITY} AS name FROM documents")
def _(t: Tables):
    name = R.entity_name(F.expr(_KINDS), {k: F.expr(v) for k, v in _CONTENT.items()})
    return t.documents.select("doc_id", name.alias("name"))


@query("write_back_canonical", f"SELECT doc_id, CASE WHEN doc_id % 6 IN (0, 1, 2) THEN 'Canonical' ELSE {_SQL_ENTITY} END AS name FROM documents")
def _(t: Tables):
    name = R.entity_name(F.expr(_KINDS), {k: F.expr(v) for k, v in _CONTENT.items()})
    return t.documents.select("doc_id", R.write_back(F.expr(_KINDS), name, F.lit("Canonical")).alias("name"))


# Every customer is an entity; many share an alias, so that the last one must win.
@query("seed_index_build", """SELECT 'alias' AS kind, lower(c_mktsegment) AS key, 'cent_' || CAST(max(c_custkey) AS STRING) AS entity FROM customer GROUP BY 2
    UNION ALL SELECT 'external', CAST(c_custkey AS STRING), 'cent_' || CAST(c_custkey AS STRING) FROM customer""")
def _(t: Tables):
    lookups = R.lookup_tables(customer_master(t))
    alias = lookups["alias"].filter("scope = 'ANY'").select(
        F.lit("alias").alias("kind"), F.col("name").alias("key"), F.col("entity.canonical_entity_id").alias("entity")
    )
    external = lookups["external"].select(
        F.lit("external").alias("kind"), F.col("id_value").alias("key"), F.col("entity.canonical_entity_id").alias("entity")
    )
    return alias.unionByName(external)


@query("register_entity", """SELECT lower(c_name) || ' group' AS key, CASE WHEN c_custkey % 2 = 0 THEN 'cent_' ELSE 'new_' END || CAST(c_custkey AS STRING) AS entity FROM customer
    UNION ALL SELECT lower(c_name), 'cent_' || CAST(c_custkey AS STRING) FROM customer WHERE c_custkey % 2 = 1""".replace("lower(c_name)", "replace(lower(c_name), '#', ' ')"))
def _(t: Tables):
    master = R.register_entities(customer_master(t), master_arrivals(t))
    names = R.lookup_tables(master)["name"].filter("scope = 'ANY'")
    return names.select(F.col("name").alias("key"), F.col("entity.canonical_entity_id").alias("entity"))
