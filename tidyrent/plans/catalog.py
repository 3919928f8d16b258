"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the given
tables, paired (where SQL can express it) with a DuckDB oracle string."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import listings_raw
from ..session import spread, stage
from . import format as fmt

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L: raw listings (they stand for the raw files a real run reads), spread
    over the cluster by ``row_id``. The exchange is also a plan boundary: the
    fixture's expressions are not fused into the formatting code."""
    return spread(listings_raw(spark, sf_dir))


def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F: stage-1 typed listings."""
    return fmt.format_listings(raw(spark, sf_dir))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: formatted + price / district / age normalisation."""
    return fmt.normalise_prices(formatted(spark, sf_dir))


def typed_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T materialised once (reliable checkpoint in the session's checkpoint
    folder) for queries that read it in several passes — the stage boundary the
    source pipeline marks with a file hand-off."""
    return stage(typed(spark, sf_dir))


def _load_all() -> None:
    # query modules register themselves on import
    from . import queries_clean, queries_format, queries_io, queries_spatial, queries_wrangle  # noqa: F401


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
