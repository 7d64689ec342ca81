"""End-to-end plans over a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchstats.operators.master import build_master
from matchstats.sources.io import load_raw_tables
from matchstats.sources.testdata import MATCH_KEYS, load_fixture_tables


class Inputs:
    """The raw inputs plus the derived master, built lazily once per plan."""

    def __init__(self, tables: dict[str, DataFrame], keys: list[str]):
        self.tables = tables
        self.keys = keys
        self._master = None

    @property
    def results(self) -> DataFrame:
        return self.tables["results"]

    @property
    def goals(self) -> DataFrame:
        return self.tables["goalscorers"]

    @property
    def shootouts(self) -> DataFrame:
        return self.tables["shootouts"]

    @property
    def former_names(self) -> DataFrame:
        return self.tables["former_names"]

    @property
    def master(self) -> DataFrame:
        if self._master is None:
            self._master = build_master(self.results, self.goals, self.shootouts, self.former_names, self.keys)
        return self._master


def fixture_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs derived from the TPC-H-like test tables (surrogate match key)."""
    return Inputs(load_fixture_tables(spark, sf_dir), MATCH_KEYS)


def csv_inputs(spark: SparkSession, data_dir: str) -> Inputs:
    """Inputs from the four CSV files (natural key date, home, away)."""
    return Inputs(load_raw_tables(spark, data_dir), ["date", "home_team", "away_team"])
