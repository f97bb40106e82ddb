"""Job records from JSON boards, forum posts and feed titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.fixed_values import JOB_BOARDS
from recordmill.functions.text import blank_to_null, has_length, role_family, snippet, strip, strip_tags
from recordmill.functions.times import iso8601, parse_timestamp
from recordmill.schemas import FORUM_POST
from recordmill.sources.envelope import envelope


def _content(
    title: Column, company: Column, date: Column, remote: Column, location: Column,
    description: Column,
) -> Column:
    return F.struct(
        title.alias("jobTitle"),
        company.alias("company"),
        date.alias("date"),
        remote.alias("is_remote"),
        role_family(title, description).alias("role_family"),
        location.alias("location"),
        blank_to_null(snippet(description)).alias("descriptionSnippet"),
    )


def jobs_json_flat(df: DataFrame, board: str | None, ref: Column, collected_at: Column) -> DataFrame:
    """One payload per job. What the board leaves out gets the board's default; a missing or
    unreadable date stays null and the record fails validation later. Without ``board`` the rows name
    theirs in ``source_name``, and all boards are read in one pass."""
    boards = {board: JOB_BOARDS[board]} if board else JOB_BOARDS
    fields = {spec[k]: "string" for spec in boards.values() for k in ("title", "company", "date", "location", "description")}
    fields |= {spec["remote_field"]: "boolean" for spec in boards.values() if spec["remote_field"]}
    shape = ", ".join(f"`{n}` {kind}" for n, kind in fields.items())
    parsed = df.withColumn("_job", F.from_json("raw_content", shape))
    own = F.lower(F.lit(board) if board else F.col("source_name"))

    def by_board(value) -> Column:
        """``value(spec)`` of the row's own board."""
        out = None
        for name, spec in boards.items():
            mine = own == name.lower()
            out = F.when(mine, value(spec)) if out is None else out.when(mine, value(spec))
        return out

    def given(key: str) -> Column:
        return by_board(lambda spec: blank_to_null(F.col(f"_job.{spec[key]}")))

    def remote_of(spec: dict) -> Column:
        if not spec["remote_field"]:
            return F.lit(True)
        return F.coalesce(F.col(f"_job.{spec['remote_field']}"), F.lit(False))

    def location_of(spec: dict) -> Column:
        default = F.lit(spec["location_default"])
        return F.when(remote_of(spec), F.lit("Remote")).otherwise(default) if spec["remote_field"] else default

    title = F.coalesce(given("title"), by_board(lambda spec: F.lit(spec["title_default"])))
    described = F.coalesce(given("description"), title)
    content = _content(
        title,
        F.coalesce(given("company"), by_board(lambda spec: F.lit(spec["company_default"]))),
        iso8601(parse_timestamp(given("date"), ref)),
        by_board(remote_of),
        F.coalesce(given("location"), by_board(location_of)),
        by_board(lambda spec: strip_tags(described) if spec["strip"] else described),
    )
    name = by_board(lambda spec: F.lit(next(n for n, s in JOB_BOARDS.items() if s is spec)))
    rows = parsed.filter(own.isin([n.lower() for n in boards]))
    return envelope(rows, "JOB", name, F.col("url"), content, collected_at)


def pipe_fields(text: Column) -> dict[str, Column]:
    """Company, title and location from the first line of a post (``a | b | c``). A part that is
    missing or too long gets a default."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    first = F.coalesce(F.get(lines, 0), F.lit("HN Tech Company"))
    parts = F.transform(F.split(first, r"\|"), strip)

    def part(i: int, size: int, default: str) -> Column:
        value = F.get(parts, i)
        return F.when(F.length(value) <= size, value).otherwise(F.lit(default))

    return {
        "company": part(0, 50, "HN Tech Company"),
        "title": part(1, 80, "Software Engineer"),
        "location": part(2, 80, "Remote / Onsite"),
    }


def jobs_pipe_posts(df: DataFrame, ref: Column, collected_at: Column) -> DataFrame:
    """Forum posts, one per payload; those under 30 characters are left out."""
    parsed = df.withColumn("_post", F.from_json("raw_content", FORUM_POST))
    given = F.coalesce(F.col("_post.comment_text"), F.lit(""))
    kept = parsed.filter(has_length(given)).withColumn("_text", strip_tags(given))
    text = F.col("_text")
    fields = pipe_fields(text)
    content = _content(
        fields["title"], fields["company"],
        iso8601(parse_timestamp(blank_to_null(F.col("_post.created_at")), ref)),
        F.contains(F.lower(text), F.lit("remote")), fields["location"], text,
    )
    return envelope(kept, "JOB", F.lit("HNWhoIsHiring"), F.col("url"), content, collected_at)


def colon_title(title: Column) -> dict[str, Column]:
    """``Company: Title`` parted at the first colon."""
    full = F.coalesce(blank_to_null(title), F.lit("WeWorkRemotely Position"))
    at = F.instr(full, ":")
    return {
        "company": F.when(at > 0, strip(F.substr(full, F.lit(1), at - 1))).otherwise(
            F.lit("WeWorkRemotely Client")
        ),
        "title": F.when(at > 0, strip(F.substr(full, at + 1))).otherwise(full),
    }


def jobs_colon_titles(items: DataFrame, ref: Column, collected_at: Column) -> DataFrame:
    """Feed items (``seq, url, title, pub_date, description``) of a remote job board."""
    fields = colon_title(F.col("title"))
    description = F.coalesce(strip_tags(F.col("description")), F.lit(""))
    content = _content(
        fields["title"], fields["company"], iso8601(parse_timestamp(F.col("pub_date"), ref)),
        F.lit(True), F.lit("Worldwide Remote"), description,
    )
    return envelope(items, "JOB", F.lit("WeWorkRemotelyAI"), F.col("url"), content, collected_at)
