import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import participation, registration, rows_of
from tidemark import schemas
from tidemark.operators import placeholders, profile
from tidemark.operators.clean import align_to_schema
from tidemark.plans import analyses
from tidemark.plans.feeds import prepare_participation, prepare_registration
from tidemark.schemas import PLACEHOLDER_DATE


def day(text):
    return dt.date.fromisoformat(text)


def history(spark, *rows):
    """Registration history from (date, ncid, {column: value})."""
    names = [*schemas.REGISTRATION_COLUMNS, "data_date"]
    data = [tuple({**registration(ncid), **values, "data_date": day(date)}[n] for n in names) for date, ncid, values in rows]
    kinds = ", ".join(f"{n} {'date' if n == 'data_date' else 'string'}" for n in names)
    return prepare_registration(spark.createDataFrame(data, kinds)).drop("_failed")


def test_classification(spark):
    df = history(
        spark,
        ("2024-01-01", "1", {"party_cd": "A"}), ("2024-01-08", "1", {"party_cd": "B"}),
        ("2024-01-15", "1", {"party_cd": "B", "res_city_desc": "X"}), ("2024-01-22", "1", {"party_cd": "B", "res_city_desc": "X", "last_name": "Z"}),
        ("2024-01-29", "1", {"party_cd": "C", "mail_city": "Y", "last_name": "Z", "res_city_desc": "X"}), ("2024-01-01", "2", {}),
    )
    found = analyses.change_classification(df).select("ncid", F.col("data_date").cast("string"), "change_class", "party_changed", "address_changed")
    assert rows_of(found) == [
        ("1", "2024-01-01", "new", False, False), ("1", "2024-01-08", "party", True, False), ("1", "2024-01-15", "address", False, True),
        ("1", "2024-01-22", "other", False, False), ("1", "2024-01-29", "party", True, True), ("2", "2024-01-01", "new", False, False),
    ]


def test_code_only_changes_and_counts(spark):
    town = {"munic_dist_desc": "SYLVA", "vtd_desc": "NORTH"}
    df = history(
        spark,
        ("2025-12-28", "1", {**town, "munic_dist_abbrv": "SY9", "vtd_abbrv": "N1", "age_at_year_end": "44"}),
        ("2026-01-04", "1", {**town, "munic_dist_abbrv": "SYLV", "vtd_abbrv": "NO", "age_at_year_end": "45"}),
        ("2026-01-11", "1", {**town, "munic_dist_abbrv": "SYL", "vtd_abbrv": "NO", "age_at_year_end": "45", "party_cd": "B"}),
        ("2026-01-18", "1", {**town, "munic_dist_abbrv": "SYL", "vtd_abbrv": "NO", "age_at_year_end": "46", "party_cd": "B"}),
        ("2026-01-25", "1", {**town, "munic_dist_abbrv": "DILL", "munic_dist_desc": "DILLSBORO", "vtd_abbrv": "NO", "age_at_year_end": "46", "party_cd": "B"}),
        ("2026-02-01", "1", {**town, "munic_dist_abbrv": "DIL", "munic_dist_desc": "DILLSBORO", "vtd_abbrv": "NO", "age_at_year_end": "48", "party_cd": "B"}),
        ("2026-01-04", "2", {}),
    )
    found = analyses.code_only_changes(df).orderBy("ncid", "data_date").select("recoded", "is_code_only").collect()
    assert [(sorted(r.recoded), r.is_code_only) for r in found] == [
        ([], False), (["munic_dist_abbrv", "vtd_abbrv"], True), (["munic_dist_abbrv"], False), ([], False), ([], False), (["munic_dist_abbrv"], False), ([], False),
    ]
    assert rows_of(analyses.changes_per_voter(df)) == [("1", 6, 5, 4), ("2", 1, 0, 0)]


def test_placeholder_reports(spark):
    hole = {"registr_dt": PLACEHOLDER_DATE, "county_id": "26", "status_cd": "A"}
    fine = {"registr_dt": "01/02/2003", "county_id": "26", "status_cd": "A"}
    df = history(
        spark, ("2024-01-01", "1", hole), ("2024-01-01", "2", hole), ("2024-01-01", "3", {**hole, "county_id": "1"}),
        ("2024-01-08", "4", hole), ("2024-01-08", "5", fine), ("2024-01-08", "6", {**fine, "county_id": "1"}),
    )
    counts = lambda found: [(str(r.data_date), r.record_count) for r in found.collect()]
    assert counts(analyses.placeholders_by_count(df)) == [("2024-01-01", 3), ("2024-01-08", 1)]
    assert counts(analyses.placeholders_by_date(df)) == [("2024-01-08", 1), ("2024-01-01", 3)]
    assert [r.ncid for r in analyses.placeholder_details(df).collect()] == ["4", "1", "2", "3"]
    breakdown = [(r.county_id, r.record_count, float(r.pct_of_placeholder_rows)) for r in analyses.placeholder_breakdown(df).collect()]
    assert breakdown == [("26", 3, 75.0), ("1", 1, 25.0)]
    share = rows_of(analyses.placeholder_share(df).withColumns({c: F.col(c).cast("double") for c in ("pct_of_group", "pct_of_placeholder_rows")}))
    assert share == [("1", 2, 1, 50.0, 25.0), ("26", 4, 3, 75.0, 75.0)]
    assert counts(analyses.placeholder_spikes(df, factor=1)) == [("2024-01-01", 3)]
    assert analyses.placeholder_share(df.limit(0)).count() == 0


def test_percentage_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(41, 4000), (1, 800), (0, 5), (3, 0)], "a long, b long")
    assert [r[0] if r[0] is None else float(r[0]) for r in df.select(profile.percentage(F.col("a"), F.col("b"))).collect()] == [1.03, 0.13, 0.0, None]


def test_backfill(spark):
    hole = {"registr_dt": PLACEHOLDER_DATE}
    df = history(
        spark, ("2024-01-01", "1", hole), ("2024-01-08", "1", hole), ("2024-01-15", "1", {"registr_dt": "01/02/2003"}),
        ("2024-01-22", "1", hole), ("2024-01-01", "2", {"registr_dt": ""}), ("2024-01-08", "2", {"registr_dt": "05/06/2007"}),
    )
    found = analyses.placeholder_backfill(df).select("ncid", F.col("data_date").cast("string"), "registr_dt", "registr_dt_filled")
    assert rows_of(found) == sorted([
        ("1", "2024-01-01", PLACEHOLDER_DATE, "01/02/2003"), ("1", "2024-01-08", PLACEHOLDER_DATE, "01/02/2003"),
        ("1", "2024-01-15", "01/02/2003", "01/02/2003"), ("1", "2024-01-22", PLACEHOLDER_DATE, None),
        ("2", "2024-01-01", "", ""), ("2", "2024-01-08", "05/06/2007", "05/06/2007"),
    ], key=repr)


def test_backfill_equals_brute_force_with_repeated_dates(spark):
    rng = random.Random(7)
    rows = [(rng.choice("kl"), dt.date(2024, 1, 1 + rng.randrange(6)), i, rng.choice([PLACEHOLDER_DATE, PLACEHOLDER_DATE, f"v{i}", "", None])) for i in range(60)]
    expected = []
    for k, d, i, v in rows:
        filled = v
        if v == PLACEHOLDER_DATE:
            later = sorted((dd, ii, vv) for kk, dd, ii, vv in rows if kk == k and (dd, ii) > (d, i) and vv not in (PLACEHOLDER_DATE, "", None))
            filled = later[0][2] if later else None
        expected.append((k, d, i, v, filled))
    df = spark.createDataFrame(rows, "k string, d date, i int, v string")
    assert rows_of(placeholders.backfill(df, "k", "d", "v", "filled", ["i"])) == sorted(expected, key=repr)


def log(spark, *rows):
    names = [*schemas.PARTICIPATION_COLUMNS, "data_date"]
    data = [tuple({**participation(ncid), **values, "data_date": day(date)}[n] for n in names) for date, ncid, values in rows]
    kinds = ", ".join(f"{n} {'date' if n == 'data_date' else 'string'}" for n in names)
    return prepare_participation(spark.createDataFrame(data, kinds)).drop("_failed")


def test_label_reports(spark):
    df = log(
        spark, ("2024-01-01", "1", {}), ("2024-01-08", "1", {"voting_method": "ELECTION DAY IN-PERSON"}), ("2024-01-01", "2", {}),
        ("2024-01-08", "2", {"election_lbl": "11/8/2022", "voting_method": "ELECTION DAY IN-PERSON"}),
    )
    assert rows_of(analyses.duplicate_profile(df)) == [(1, 2, 2.0, 3, 4)]
    drift = analyses.voting_method_drift(df).withColumn("pct_of_period", F.col("pct_of_period").cast("double"))
    assert rows_of(drift) == [("ELECTION DAY IN-PERSON", 2020, 1, 33.33), ("ELECTION DAY IN-PERSON", 2022, 1, 100.0), ("IN-PERSON", 2020, 2, 66.67)]
    assert rows_of(analyses.voting_method_span(df)) == [
        ("ELECTION DAY IN-PERSON", day("2020-11-03"), day("2022-11-08"), 2), ("IN-PERSON", day("2020-11-03"), day("2020-11-03"), 2),
    ]
    newest = analyses.latest_label_versions(df).select("ncid", "voting_method")
    assert rows_of(newest) == [("1", "ELECTION DAY IN-PERSON"), ("2", "ELECTION DAY IN-PERSON"), ("2", "IN-PERSON")]
    widths = {r.column_name: (r.declared_width, r.max_length, r.rows_over_width, r.conforms) for r in analyses.participation_conformance(df).collect()}
    assert widths["voting_method"] == (10, 22, 2, False) and widths["ncid"] == (12, 1, 0, True)


def test_views_links_and_codes(spark):
    df = history(
        spark, ("2020-01-01", "1", {"party_cd": "A", "status_cd": "A", "race_code": "W", "ethnic_code": "NL", "county_id": "00"}),
        ("2021-01-01", "1", {"party_cd": "B", "status_cd": "Q", "race_code": "W", "ethnic_code": "NL", "county_id": "00"}),
    )
    assert rows_of(analyses.latest_registrations(df).select("party_cd")) == [("B",)]
    assert rows_of(analyses.latest_registrations(df, "2020-06-01").select("party_cd")) == [("A",)]
    part = log(spark, ("2024-01-01", "1", {}), ("2024-01-01", "9", {}))
    assert rows_of(analyses.participation_with_registration(df, part).select("ncid", "party_cd")) == [("1", "B")]
    assert rows_of(analyses.participation_with_registration(df, part, as_of_election=True).select("ncid", "party_cd")) == [("1", "A")]
    decoded = analyses.decode_registrations(spark, df).orderBy("data_date").select("status_name", "race_name", "county_name").collect()
    assert [tuple(r) for r in decoded] == [("ACTIVE", "WHITE", "YANCEY"), (None, "WHITE", "YANCEY")]
    assert rows_of(analyses.unknown_registration_codes(spark, df)) == [("status_cd", "Q", 1)]
    assert analyses.registration_conformance(df).count() == 66
    assert align_to_schema(df, schemas.REGISTRATION_TABLE).columns == schemas.REGISTRATION_TABLE.names
