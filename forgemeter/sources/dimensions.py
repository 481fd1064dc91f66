"""Static dimension tables."""

from __future__ import annotations

import csv
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter import schemas

# The language rankings (language, tier, paradigm, type).
LANGUAGE_RANKINGS_CSV = """\
language,tier,paradigm,type
Python,1,multi-paradigm,interpreted
JavaScript,1,multi-paradigm,interpreted
TypeScript,1,multi-paradigm,interpreted
Java,1,object-oriented,compiled
C,1,procedural,compiled
C++,1,multi-paradigm,compiled
C#,1,object-oriented,compiled
Go,1,concurrent,compiled
Rust,1,systems,compiled
Kotlin,1,multi-paradigm,compiled
Swift,1,multi-paradigm,compiled
PHP,1,multi-paradigm,interpreted
Ruby,1,object-oriented,interpreted
Scala,2,functional,compiled
R,2,statistical,interpreted
MATLAB,2,numerical,interpreted
Shell,2,scripting,interpreted
PowerShell,2,scripting,interpreted
Dart,2,object-oriented,compiled
Lua,2,scripting,interpreted
Perl,2,multi-paradigm,interpreted
Haskell,2,functional,compiled
Elixir,2,functional,interpreted
Clojure,2,functional,compiled
F#,2,functional,compiled
Erlang,2,concurrent,compiled
Julia,2,numerical,compiled
Objective-C,2,object-oriented,compiled
Assembly,2,imperative,compiled
Groovy,2,object-oriented,interpreted
Vim Script,3,scripting,interpreted
Makefile,3,declarative,interpreted
Dockerfile,3,declarative,interpreted
HTML,3,markup,interpreted
CSS,3,declarative,interpreted
SCSS,3,declarative,interpreted
Less,3,declarative,interpreted
CoffeeScript,3,multi-paradigm,interpreted
ActionScript,3,object-oriented,compiled
Fortran,3,procedural,compiled
COBOL,3,procedural,compiled
Ada,3,concurrent,compiled
Prolog,3,logic,interpreted
Scheme,3,functional,interpreted
Common Lisp,3,multi-paradigm,interpreted
OCaml,3,functional,compiled
Racket,3,functional,interpreted
Crystal,3,object-oriented,compiled
Nim,3,multi-paradigm,compiled
Zig,3,systems,compiled
"""


def read_language_rankings(spark: SparkSession, path: str) -> DataFrame:
    """The rankings from a header CSV that all executors can read; every column is text."""
    return spark.read.schema(schemas.LANGUAGE_RANKINGS).option("header", True).csv(path)


def ranking_rows() -> list[dict[str, str]]:
    return list(csv.DictReader(io.StringIO(LANGUAGE_RANKINGS_CSV)))


def language_rankings(spark: SparkSession) -> DataFrame:
    """The rankings above as a local relation, whose exact size Catalyst knows."""
    rows = ranking_rows()
    columns = {name: [r[name] for r in rows] for name in schemas.LANGUAGE_RANKINGS.names}
    return spark.createDataFrame(pa.table(columns), schema=schemas.LANGUAGE_RANKINGS)


def trend_weight(event_type: Column, weights: dict[str, int] | None = None) -> Column:
    """Weight of an event type, 0 when it is not listed.

    The map is a literal of a few entries, so this is a projection and not a join.
    """
    weights = schemas.EVENT_WEIGHTS if weights is None else weights
    pairs = [F.lit(part) for entry in weights.items() for part in entry]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), event_type), F.lit(0)).cast("int")


def repo_languages(sightings: DataFrame) -> DataFrame:
    """One language per repository out of many sightings, the greatest when they differ.

    The first step groups by both columns and so runs by hash; max(language) over the raw
    rows has a text buffer and would make Spark sort them. The count keeps the optimizer
    from merging the steps, which it does when the first one computes nothing.
    """
    return (
        sightings.where((F.col("repo_name") != "") & (F.col("language") != ""))
        .groupBy("repo_name", "language")
        .agg(F.count(F.lit(1)).alias("seen"))
        .groupBy("repo_name")
        .agg(F.max("language").alias("language"), F.sum("seen").alias("seen"))
        .where("seen > 0")
        .select("repo_name", "language")
    )
