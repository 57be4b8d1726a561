"""Secrets by patterns, told apart by how many repositories and owners hold them; column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import matches
from readloom.operators.staging import stage

# As in the docstring of `find`, written so that no run of characters is tried at each of its starts.
ASSIGN = (
    r"(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?+\x20*+[:=]\x20*+[\"']?+[A-Za-z0-9+/_.=-]++"
)
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"

#: Kinds in the order that breaks ties of the start.
KINDS = ("assign", "access", "hex")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
#: What an assignment holds before its value.
ASSIGN_HEAD = r"^[A-Za-z_]+[\"']?\x20*[:=]\x20*[\"']?"
#: A value of this many owners is a copied example.
EXAMPLE_OWNERS = 3
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|^(.)\1+$|^(?:x{4,}|\*+|1234\d*)$"


def secret(kind: str, value: Column) -> Column:
    """The credential itself, without the name it is assigned to."""
    return F.regexp_replace(value, ASSIGN_HEAD, "") if kind == "assign" else value


def spans_of(text: Column, kind: str, order: int) -> Column:
    spans = F.transform(
        matches(text, PATTERNS[kind]),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(order).alias("kind_no"),
            F.lit(kind).alias("kind"),
            m["stop"].alias("stop"),
            secret(kind, m["value"]).alias("value"),
        ),
    )
    return F.filter(spans, lambda s: F.length(s["value"]) >= 6) if kind == "assign" else spans


def owner_of(repository: Column) -> Column:
    """``owner`` of ``owner/name``; a name without a slash is its own owner."""
    return F.substring_index(repository, "/", 1)


def ownership(candidates: DataFrame) -> DataFrame:
    """``(value_hash, n_repos, n_owners, n_docs)`` of ``(value_hash, repository)`` rows, nulls not counted.

    Rows are first summed per value and repository on the map side, so a value in a
    third of all rows shuffles one row per repository and task.
    """
    by_repo = candidates.groupBy("value_hash", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("value_hash", owner_of(F.col("repository")).alias("owner")).agg(
        F.count("repository").alias("repos"), F.sum("n").alias("n")
    )
    return by_owner.groupBy("value_hash").agg(
        F.sum("repos").alias("n_repos"), F.count("owner").alias("n_owners"), F.sum("n").alias("n_docs")
    )


def find(docs: DataFrame, repository: str = "source") -> DataFrame:
    """``(doc_id, secrets)`` for every row; ``secrets`` is an array of spans by start, then kind.

    A span has ``kind, start, stop, value_hash, n_repos, n_owners, verdict``. Plain
    forms, leftmost and non-overlapping per kind: assign
    ``(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)`` in
    either case with a value of 6 or more characters; access ``AKIA[A-Z0-9]+`` of 20 or
    more; hex ``[0-9a-f]+`` of 24 or more. What is too short is dropped and not tried
    again. Offsets are code points, ``stop`` is exclusive.

    The hash of each value is counted over the whole corpus by distinct repositories
    and owners. ``verdict``: ``example`` if the value reads like a placeholder or has
    ``EXAMPLE_OWNERS`` owners or more, ``live`` if at most one owner has it, else
    ``shared``. Null texts are empty, null repositories own nothing, repeated rows
    stay. Values are kept as SHA-256 only. Other columns are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    raw = F.concat(*[spans_of(text, kind, i) for i, kind in enumerate(KINDS)])
    hashed = F.transform(
        F.array_sort(raw),
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            F.sha2(s["value"], 256).alias("value_hash"),
            s["value"].rlike(PLACEHOLDER).alias("placeholder"),
        ),
    )
    rows = docs.select("doc_id", F.col(repository).cast("string").alias("repository"), hashed.alias("spans"))
    # Row numbers are written down, so they stay what they are when a task runs again.
    rows = stage(rows.withColumn("row_no", F.monotonically_increasing_id()), "secrets")
    each = rows.select("row_no", "repository", F.posexplode("spans").alias("at", "s"))
    each = each.select("row_no", "repository", "at", "s", F.col("s.value_hash").alias("value_hash"))
    known = each.join(ownership(each), "value_hash")
    verdict = (
        F.when(F.col("s.placeholder") | (F.col("n_owners") >= EXAMPLE_OWNERS), "example")
        .when(F.col("n_owners") <= 1, "live")
        .otherwise("shared")
    )
    span = F.struct(
        "at", *[F.col(f"s.{c}").alias(c) for c in ("kind", "start", "stop", "value_hash")], "n_repos", "n_owners", verdict.alias("verdict")
    )
    judged = known.groupBy("row_no").agg(F.array_sort(F.collect_list(span)).alias("judged"))
    empty = F.array().cast(judged.schema["judged"].dataType)
    return rows.join(judged, "row_no", "left").select(
        "doc_id", F.transform(F.coalesce("judged", empty), lambda s: s.dropFields("at")).alias("secrets")
    )
