"""Analyses over the stored tables, with the tables' own columns filled in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import joins, placeholders, profile, versions
from tidemark.operators.keys import as_of_view, latest_per_key
from tidemark.schemas import ELECTION_DATE, KEY, SNAPSHOT_DATE
from tidemark.sources.tables import dim_county, dim_ethnicity, dim_race, dim_status

BREAKDOWN = ["county_id", "status_cd", "voter_status_desc", "reason_cd", "voter_status_reason_desc"]
REGISTERED_ON = "registr_dt"


# --- placeholder registration dates ---

def placeholders_by_count(df: DataFrame, column: str = REGISTERED_ON, date: str = SNAPSHOT_DATE) -> DataFrame:
    """Placeholder rows per snapshot date, most first."""
    return profile.count_by(placeholders.placeholder_rows(df, column), date).orderBy(F.desc("record_count"), F.desc(date))


def placeholders_by_date(df: DataFrame, column: str = REGISTERED_ON, date: str = SNAPSHOT_DATE) -> DataFrame:
    """Placeholder rows per snapshot date, newest first."""
    return profile.count_by(placeholders.placeholder_rows(df, column), date).orderBy(F.desc(date))


def placeholder_details(df: DataFrame, column: str = REGISTERED_ON, date: str = SNAPSHOT_DATE, key: str = KEY) -> DataFrame:
    """The placeholder rows, newest first. The key in the sort lets a date with very many rows be split."""
    return placeholders.placeholder_rows(df, column).orderBy(F.desc(date), key)


def placeholder_breakdown(df: DataFrame, keys: list[str] | None = None, column: str = REGISTERED_ON) -> DataFrame:
    """Placeholder rows by county, status and reason with their share of all placeholder rows."""
    keys = keys or BREAKDOWN
    counts = profile.count_by(placeholders.placeholder_rows(df, column), *keys)
    shares = profile.with_percent_of_total(counts, "record_count", "pct_of_placeholder_rows")
    return shares.orderBy(F.desc("record_count"), *keys)


def placeholder_share(df: DataFrame, group: str = "county_id", column: str = REGISTERED_ON) -> DataFrame:
    """Share of placeholder rows per group, and each group's share of all placeholder rows."""
    return placeholders.placeholder_share(df, column, group)


def placeholder_spikes(df: DataFrame, factor: int = 3, column: str = REGISTERED_ON, date: str = SNAPSHOT_DATE) -> DataFrame:
    """Snapshot dates with unusually many placeholder rows."""
    return placeholders.placeholder_spikes(df, column, date, factor)


def placeholder_backfill(df: DataFrame) -> DataFrame:
    """Registration dates with placeholders filled from the next valid value, in `registr_dt_filled`."""
    return placeholders.backfill(df, KEY, SNAPSHOT_DATE, REGISTERED_ON, "registr_dt_filled")


# --- changes between versions ---

def change_classification(df: DataFrame) -> DataFrame:
    """Every version as new registration, party change, address move or other change."""
    groups = {"party": schemas.PARTY_COLUMNS, "address": schemas.ADDRESS_COLUMNS}
    return versions.classify_changes(df, KEY, SNAPSHOT_DATE, groups)


def code_only_changes(df: DataFrame) -> DataFrame:
    """Versions that differ only in codes whose descriptions stayed the same (ages may grow by one)."""
    return versions.code_only_changes(df, KEY, SNAPSHOT_DATE, schemas.CODE_PAIRS, ["age_at_year_end"])


def changes_per_voter(df: DataFrame) -> DataFrame:
    """Changes per person, with and without code-only versions."""
    return versions.changes_per_key(code_only_changes(df), KEY)


# --- views and links ---

def latest_registrations(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Current state of every registration, or its state on a date."""
    if as_of is None:
        return latest_per_key(df, [KEY], SNAPSHOT_DATE)
    return as_of_view(df, [KEY], SNAPSHOT_DATE, as_of)


def participation_with_registration(registrations: DataFrame, participations: DataFrame, as_of_election: bool = False) -> DataFrame:
    """Participation rows with the person's current registration, or the one in force on election day."""
    log = participations.drop(SNAPSHOT_DATE)
    if as_of_election:
        return joins.link_history_as_of(registrations, log, KEY, SNAPSHOT_DATE, ELECTION_DATE)
    return joins.link_history(registrations, log, KEY, SNAPSHOT_DATE)


def decode_registrations(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Registrations with the descriptions of their status, race, ethnicity and county codes."""
    for dim, code in ((dim_status, "status_cd"), (dim_race, "race_code"), (dim_ethnicity, "ethnic_code"), (dim_county, "county_id")):
        dimension = dim(spark)
        description = dimension.columns[1]
        df = joins.decode(df, code, dimension, code, description, description)
    return df


def unknown_registration_codes(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Codes in the table that the code lists do not have, with their number of rows."""
    parts = None
    for dim, code in ((dim_status, "status_cd"), (dim_race, "race_code"), (dim_ethnicity, "ethnic_code"), (dim_county, "county_id")):
        found = joins.unknown_codes(df, code, dim(spark), code).select(
            F.lit(code).alias("column_name"), F.col(code).alias("code"), "row_count"
        )
        parts = found if parts is None else parts.unionByName(found)
    return parts


# --- participation log ---

def duplicate_profile(df: DataFrame) -> DataFrame:
    """How many (person, election) groups have several rows."""
    return profile.duplicate_profile(df, [KEY, ELECTION_DATE])


def voting_method_drift(df: DataFrame) -> DataFrame:
    """Share of each voting method per election year. Labels are compared as reported, never merged."""
    return profile.label_drift(df, "voting_method", F.year(ELECTION_DATE))


def voting_method_span(df: DataFrame) -> DataFrame:
    """First and last election of each voting method."""
    return profile.label_span(df, "voting_method", ELECTION_DATE)


def latest_label_versions(df: DataFrame) -> DataFrame:
    """Only the newest version per (person, election) of a log that has snapshot dates."""
    ties = [c for c in df.columns if c not in (KEY, ELECTION_DATE, SNAPSHOT_DATE)]
    return latest_per_key(df, [KEY, ELECTION_DATE], SNAPSHOT_DATE, ties)


def registration_conformance(df: DataFrame) -> DataFrame:
    """Longest value per registration column against its declared width."""
    return profile.layout_conformance(df, schemas.REGISTRATION_WIDTHS)


def participation_conformance(df: DataFrame) -> DataFrame:
    """Longest value per participation column against its declared width."""
    return profile.layout_conformance(df, schemas.PARTICIPATION_WIDTHS)
