"""Sources, profiles, the feed, anomalies and the jobs."""

import math

import pytest
from pyspark.sql import types as T

from plumbline.functions.text import normalise_name
from plumbline.operators import anomaly, profiling, reports
from plumbline.plans import jobs
from registry.domain import domain_tables
from plumbline.schemas import EVENT, PROVIDER_FEED, TABLES
from plumbline.session import fresh_path, shared_folder
from plumbline.sources.sinks import write_report
from plumbline.sources.tables import dataset_spec, read_csv, read_dataset, read_folder, read_tolerant, stage
from plumbline.streaming import feed

SF = "/root/testdata/sf0.001"
AS_OF = "2025-06-30"


def test_csv_reader_keeps_text_and_drops_na_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,code,score\n1,N/A,0.5\n2,"",bad\n3,"a, ""b""",nan\n')
    got = [tuple(r) for r in read_csv(spark, str(tmp_path / "t.csv")).orderBy("id").collect()]
    assert got == [("1", None, "0.5"), ("2", None, "bad"), ("3", 'a, "b"', None)]
    assert list(read_folder(spark, str(tmp_path))) == ["t"]
    with pytest.raises(FileNotFoundError):
        read_folder(spark, str(tmp_path), ".tsv")


def test_tolerant_reader_drops_bad_rows(spark, tmp_path):
    (tmp_path / "p.csv").write_text("provider_record_id,score\na,0.5\nb,oops\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("provider_record_id", T.StringType()), T.StructField("score", T.DoubleType())])
    read_tolerant(spark, str(tmp_path / "p.csv"), schema, "p")
    assert [r.score for r in spark.sql("SELECT score FROM p WHERE score > 0").collect()] == [0.5]


def test_staging_turns_unparseable_values_into_null(spark):
    df = spark.createDataFrame([("P", "x", "2024-02-30"), ("Q", "0.5", "2024-02-29")],
                               "provider_record_id STRING, confidence_score STRING, feed_date STRING")
    full = df.selectExpr(*[f.name if f.name in df.columns else f"CAST(NULL AS STRING) AS {f.name}" for f in PROVIDER_FEED.fields])
    got = stage(full, TABLES["provider_feed"]).orderBy("provider_record_id").collect()
    assert got[0].confidence_score is None and got[0].feed_date is None
    assert got[1].confidence_score == 0.5 and str(got[1].feed_date) == "2024-02-29"


def test_registry(spark, tmp_path):
    spec = dataset_spec("counterparty_trade_links")
    assert spec.primary_key == "trade_id" and len(spec.required_columns) == 24
    with pytest.raises(ValueError, match="counterparty_trade_links"):
        dataset_spec("nothing")
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, spec, str(tmp_path))


def test_names_become_comparable(spark):
    df = spark.createDataFrame([("Northbridge Holdings Limited",), ("A.B. Corp-Group plc ",), ("Limitedx",), (None,)], "n STRING")
    assert [r[0] for r in df.select(normalise_name("n")).collect()] == ["NORTHBRIDGE", "A B", "LIMITEDX", None]


def test_profiles(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", " ", 2.0), ("b", "x", 2.0), (None, None, 2.0)], "k STRING, v STRING, d DOUBLE")
    got = {r.column_name: r for r in profiling.profile(df, "t").collect()}
    assert (got["k"].missing_count, got["k"].unique_count, got["k"].missing_pct) == (1, 2, 25.0)
    assert [(i.value, i.rows) for i in got["k"].top_values] == [("a", 2), ("b", 1), ("nan", 1)]
    assert got["d"].dtype == "double" and got["d"].unique_pct == 50.0
    onboarded = {r.column_name: r for r in profiling.onboarding_profile(df, "t", "k").collect()}
    v = onboarded["v"]
    # A missing value is blank too and is counted in both columns.
    assert (v.missing_count, v.blank_count, v.missing_or_blank_count, v.missing_or_blank_distinct) == (2, 3, 5, 3)
    assert v.sample_values == "  | x" and onboarded["k"].sample_values == "a | a | b"
    estimated = {r.column_name: r for r in profiling.approximate_profile(df, "t").collect()}
    assert estimated["d"].approx_unique_count == 2 and estimated["v"].missing_count == 2


def test_nan_is_missing_in_profiles(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    facts = profiling.profile(df, "t").first()
    assert (facts.missing_count, facts.unique_count) == (2, 1)


def test_profiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k STRING, d DATE")
    got = profiling.profile(df, "t").collect()
    assert [(r.column_name, r.row_count, r.missing_pct, r.top_values) for r in got] == [("k", 0, 0.0, []), ("d", 0, 0.0, [])]
    assert [(r.total_rows, r.missing_or_blank_pct) for r in profiling.onboarding_profile(df, "t", "k").collect()] == [(0, 0.0)] * 2


PAYLOADS = [
    ("P1", "Alpha", "US", 0.5, ""),
    ("P2", None, "US", 0.5, "Missing legal name"),
    ("P3", " ", "XX", math.nan, "Missing legal name; Invalid country code; Invalid confidence score"),
    ("P4", "Beta", None, 1.0, "Invalid country code"),
    (None, "Gamma", "GB", -0.1, "Invalid confidence score"),
]


def provider_rows(spark):
    rows = [(i, "ProviderA" if i else None, name, country, "R", "s", "Active", score, None) for i, name, country, score, _ in PAYLOADS]
    return spark.createDataFrame(rows, PROVIDER_FEED)


@pytest.mark.parametrize("limit", [100, None])
def test_stream_gives_what_the_batch_gives(spark, limit):
    messages, manifest = feed.feed_run(provider_rows(spark), "r1", limit)
    other = feed.encode(feed.build_events(feed.first_records(provider_rows(spark), 100), "r0"))
    feed.publish_files(other, messages)
    out, archive = fresh_path(spark, "out"), fresh_path(spark, "archive")
    for _ in range(2):  # running again must not repeat anything
        feed.run_validation(feed.stream_files(spark, messages, 1), "r1", out, archive)
    streamed = spark.read.parquet(out)
    batch = feed.validate_events(feed.decode(spark.read.text(messages)), "r1")
    columns = ["event_id", "sequence_number", "provider_record_id", "status", "issue_count", "issues"]
    assert sorted(map(str, streamed.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    assert {r.provider_record_id: r.issues for r in batch.collect()} == {p[0]: p[4] for p in PAYLOADS}
    assert sorted(r.sequence_number for r in streamed.collect()) == [1, 2, 3, 4, 5]
    assert tuple(feed.completeness(streamed, feed.read_manifest(spark, manifest)).first()) == ("r1", 5, 5, True)
    assert feed.failed_events(streamed).count() == 4
    summary = {(r.provider_name, r.status): (r.event_count, r.total_issues) for r in feed.feed_summary(streamed).collect()}
    assert summary == {(None, "failed"): (1, 1), ("ProviderA", "failed"): (3, 5), ("ProviderA", "passed"): (1, 0)}
    archived = spark.read.schema(EVENT).json(archive)
    assert archived.count() == 5 and feed.preview_events(spark, archive, 2).count() == 2
    keys = {r.key for r in feed.encode(feed.decode(spark.read.text(messages)).where("run_id = 'r1'")).collect()}
    assert {"P1", "P2", "P3", "P4"} < keys and None not in keys


def test_no_events_of_the_run_is_an_error(spark):
    messages, _ = feed.feed_run(provider_rows(spark), "r1")
    with pytest.raises(RuntimeError):
        feed.require_events(feed.validate_events(feed.decode(spark.read.text(messages)), "other"))


def entities(spark, n=600):
    from datetime import date, timedelta

    rows = []
    for i in range(n):
        row = dict(entity_id=f"E{i:04d}", legal_name="Name" + "x" * (i % 7), country_code=["US", "GB", "DE"][i % 3],
                   registration_number=f"R{i}", entity_type=["Fund", "SPV"][i % 2], sector="Energy", status="Active",
                   last_verified_date=date(2025, 6, 30) - timedelta(days=i % 90), source_system=["A", "B"][i % 2])
        if i in (17, 401):
            row.update(legal_name=None, country_code="ZZ", registration_number=None, sector=None, status="Odd",
                       last_verified_date=date(2001, 1, 1), source_system="Z")
        rows.append(tuple(row.get(f.name) for f in TABLES["entities"].fields))
    return spark.createDataFrame(rows, TABLES["entities"])


def test_anomalies_are_the_planted_ones_and_do_not_depend_on_partitioning(spark):
    df = entities(spark)
    one = anomaly.score_entities(df.repartition(3), AS_OF, trees=40)
    other = anomaly.score_entities(df.repartition(7, "entity_id"), AS_OF, trees=40)
    rows = {r.entity_id: r.anomaly_score for r in one.collect()}
    assert rows == {r.entity_id: r.anomaly_score for r in other.collect()}
    ranked = anomaly.anomalies(one).collect()
    assert {r.entity_id for r in ranked[:2]} == {"E0017", "E0401"}
    assert len(ranked) <= 0.03 * len(rows) + 1
    assert all(r.anomaly_score <= 0 for r in ranked)


def test_labels_and_scores_against_a_plain_forest(spark, monkeypatch):
    """The same trees walked row by row in plain Python give the scores, the threshold, the labels and the totals."""
    df, fitted = entities(spark), []
    fit = anomaly.fit_forest
    monkeypatch.setattr(anomaly, "fit_forest", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    scored = anomaly.score_entities(df, AS_OF, trees=25)
    got = {r.entity_id: r for r in scored.collect()}
    (forest,) = fitted

    def depth(tree, row):
        feature, threshold, code, left, right, path = (x.tolist() for x in tree)
        at = 0
        while feature[at] >= 0:
            f = feature[at]
            if f < len(anomaly.NUMERIC):
                goes_right = row[f] > threshold[at]
            else:
                goes_right = forest.codes[f - len(anomaly.NUMERIC)].get(row[f]) == code[at]
            at = right[at] if goes_right else left[at]
        return path[at]

    norm = anomaly.average_path(forest.sample_size)
    features = {r.entity_id: [r[f] for f in anomaly.FEATURES] for r in anomaly.impute(anomaly.entity_features(df, AS_OF)).collect()}
    scores = {i: -2.0 ** -(sum(depth(t, row) for t in forest.tables) / len(forest.tables) / norm) for i, row in features.items()}
    ordered = sorted(scores.values())
    place = (len(ordered) - 1) * anomaly.CONTAMINATION
    low = ordered[math.floor(place)]
    threshold = low + (ordered[math.floor(place) + 1] - low) * (place - math.floor(place))
    assert set(got) == set(scores)
    assert all(abs(got[i].anomaly_score - (s - threshold)) < 1e-5 for i, s in scores.items())
    labelled = {i for i, s in scores.items() if s - threshold < -1e-12}
    assert {i for i, r in got.items() if r.anomaly_label == "Anomaly"} == labelled and labelled
    sources = {}
    for i in labelled:
        sources[got[i].source_system] = sources.get(got[i].source_system, 0) + 1
    totals = reports.anomalies_by_source(anomaly.anomalies(scored)).collect()
    assert {r.source_system: r.anomaly_count for r in totals} == sources


def test_percentile_by_refinement_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = -rng.beta(2, 5, 500).round(4)
    counts = rng.integers(1, 5, 500)
    df = spark.createDataFrame([(float(v), int(c)) for v, c in zip(values, counts)], "score DOUBLE, n BIGINT")
    expected = np.percentile(np.repeat(values, counts), 3)
    assert anomaly.weighted_percentile(df, 0.03, buckets=8) == pytest.approx(expected, abs=1e-15)


def test_copies_of_one_row_do_not_swell_the_sample(spark):
    """A feature row holding a third of a large table stays one group and a bounded part of the pool."""
    base = anomaly.entity_features(entities(spark), AS_OF)
    groups = anomaly.feature_groups(base).selectExpr(*anomaly.FEATURES, "n * 1000000 AS n")
    forest = anomaly.fit_forest(groups, trees=5)
    assert len(forest.tables) == 5 and all(len(t[0]) <= 2 * anomaly.SAMPLE for t in forest.tables)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_full_run(spark):
    out = jobs.full_job(domain_tables(spark, SF), fresh_path(spark, "job"), AS_OF)
    assert list(out) == list(jobs.STAGES) == ["core", "onboarding", "sql", "remediation"]
    results = out["core"]["rule_results"].collect()
    assert len(results) == 27 and all((r.failed_examples == "[]") == (r.failed_count == 0) for r in results)
    (summary,) = out["onboarding"]["run_summary"].collect()
    assert summary.rules_executed == out["onboarding"]["rule_results"].count()
    assert summary.exceptions_generated == out["onboarding"]["failed_records"].count()
    assert summary.total_columns == len(domain_tables(spark, SF)["counterparty_trade_links"].columns)
    core = out["core"]
    assert core["rule_results"].count() == 27 and core["kpi_snapshot"].first().tables_checked == 5
    assert {"Critical"} == {r.severity for r in core["critical_failures"].collect()}
    assert set(core["quality_scorecard"].columns) >= {"table_name", "dimension", "quality_score", "status"}
    assert out["onboarding"]["failed_records"].count() == out["onboarding"]["rule_results"].agg({"failed_count": "sum"}).first()[0]
    assert out["sql"]["rule_results"].count() == 18
    remediated = out["remediation"]
    assert remediated["curated"].count() > 0 and remediated["quarantined"].count() > 0


def test_sql_rule_file_keeps_semicolons_in_comments_and_texts():
    from plumbline.operators.sqlrules import read_annotated_rules

    head = "-- RULE_ID: {}\n-- SEVERITY: High\n-- DIMENSION: Validity\n-- DESCRIPTION: one; two\n-- RECOMMENDATION: none\n"
    text = head.format("A") + "SELECT * FROM t WHERE a = ';' /* ; */;\n" + head.format("B") + "SELECT * FROM t;\n"
    rules = read_annotated_rules(text)
    assert [r.rule_id for r in rules] == ["A", "B"] and rules[0].description == "one; two"
    with pytest.raises(ValueError):
        read_annotated_rules("-- RULE_ID: A\nSELECT 1;")


def test_failing_rows_of_good_rules_survive_a_broken_one(spark):
    from plumbline.operators.sqlrules import sql_failed_rows
    from plumbline.rules.trades_sql import SqlRule

    df = spark.createDataFrame([(1,), (2,)], "a int")
    rules = [SqlRule("A", "High", "Validity", "", "", query="SELECT a FROM t_rules WHERE a > 1"), SqlRule("B", "High", "Validity", "", "", query="SELECT nothing FROM t_rules")]
    assert [(r.rule_id, r.a) for r in sql_failed_rows(df, rules, "t_rules").collect()] == [("A", 2)]


def test_csv_rows_do_not_depend_on_the_columns_selected(spark, tmp_path):
    from plumbline.sources.tables import read_csv, read_tolerant

    (tmp_path / "a.csv").write_text("id,n\n1,2\n2,x\n3,4\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    df = read_tolerant(spark, str(tmp_path / "a.csv"), schema, "tolerant_rows")
    assert df.count() == len(df.collect()) == len(df.select("id").collect()) == 2
    (tmp_path / "b.csv").write_text('id,t\n1,"a\nb"\n2,c\n')
    assert [r.t for r in read_csv(spark, str(tmp_path / "b.csv"), multi_line=True).orderBy("id").collect()] == ["a\nb", "c"]


def test_literals_beyond_the_basic_plane(spark):
    from plumbline.functions.text import literal

    assert spark.sql(f"SELECT {literal('a😀é')} AS x").first().x == "a😀é"


def test_all_anomalies_are_reported(spark):
    from plumbline.operators import anomaly

    rows = [(i, "s", "Anomaly" if i % 2 else "Normal", -0.1) for i in range(1000)]
    df = spark.createDataFrame(rows, "entity_id int, source_system string, anomaly_label string, anomaly_score double")
    assert anomaly.anomalies(df).count() == 500


def test_samples_of_sparse_columns_and_tied_keys(spark):
    rows = [(None if i % 11 == 0 else f"k{i // 40:03d}", "x" if i % 97 == 0 else None, float(i) if i % 3 else float("nan"), None)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "k STRING, sparse STRING, num DOUBLE, empty STRING").repartition(6)
    texts = [tuple(None if v is None or v != v else str(v) for v in r) for r in rows]
    ordered = sorted(texts, key=lambda r: (r[0] is None, *[(v is not None, v or "") for v in r]))
    for n in (1, 5, 12):
        got = {r.column_name: r.sample_values for r in profiling.sample_values(df, "k", n).collect()}
        for i, c in enumerate(df.columns):
            want = [r[i] for r in ordered if r[i] is not None][:n]
            assert got.get(c, "") == " | ".join(want), c
    assert profiling.sample_values(df.limit(0), "k").count() == 0


REGISTRY_YAML = """
datasets:
  people:
    file_path: incoming/people.csv
    primary_key: id
    required_columns: [id, role]
    date_columns: [since]
    allowed_values:
      role: [Lead, Member]
      elsewhere: ["NO"]
  other: {file_path: o.csv, primary_key: k}
"""


def test_registry_file(spark, tmp_path):
    from plumbline.sources.tables import load_registry

    (tmp_path / "r.yml").write_text(REGISTRY_YAML)
    known = load_registry(spark, str(tmp_path / "r.yml"))
    assert list(known) == ["people", "other"] and known["people"].allowed_values["elsewhere"] == ("NO",)
    assert dataset_spec("other", known).required_columns == ()
    (tmp_path / "incoming").mkdir()
    (tmp_path / "incoming" / "people.csv").write_text('id,role,since\n1,Lead,2024-01-01\n1,"Mem\nber",soon\n,Member,2024-02-30\n')
    out = jobs.onboarding_job(read_dataset(spark, known["people"], str(tmp_path)), fresh_path(spark, "people"), known["people"])
    failed = {r.rule_id: r.failed_count for r in out["rule_results"].collect()}
    assert failed == {"SCHEMA_001": 0, "KEY_001": 1, "KEY_002": 2, "DATE_since": 2, "SET_role": 1}
    assert out["failed_records"].count() == 6
    with pytest.raises(FileNotFoundError):
        load_registry(spark, str(tmp_path / "none.json"))
    for wrong in ('{"x": 1}', '{"datasets": {"a": {"file_path": "p"}}}', '{"datasets": {"a": {"file_path": "p", "primary_key": "k", "colums": []}}}',
                  "datasets: {a: {file_path: p, primary_key: k, allowed_values: {c: [NO]}}}"):
        (tmp_path / "wrong.json").write_text(wrong)
        with pytest.raises(ValueError):
            load_registry(spark, str(tmp_path / "wrong.json"))


def test_restart_in_the_middle_of_a_batch(spark, monkeypatch):
    from pyspark.errors import StreamingQueryException

    messages, _ = feed.feed_run(provider_rows(spark), "r1")
    out, archive = fresh_path(spark, "out"), fresh_path(spark, "archive")
    whole, calls = feed._archive_batch, []

    def breaks_once(events, path, batch_id):
        calls.append(batch_id)
        if len(calls) == 2:
            raise OSError("disk gone")  # the validated events of this batch are written by now
        whole(events, path, batch_id)

    monkeypatch.setattr(feed, "_archive_batch", breaks_once)
    with pytest.raises(StreamingQueryException):
        feed.run_validation(feed.stream_files(spark, messages, 1), "r1", out, archive)
    feed.run_validation(feed.stream_files(spark, messages, 1), "r1", out, archive, require=True)
    assert calls.count(calls[1]) == 2
    for kept in (spark.read.parquet(out), spark.read.schema(EVENT).json(archive)):
        assert sorted(r.sequence_number for r in kept.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(RuntimeError):
        feed.run_validation(feed.stream_files(spark, messages), "other", fresh_path(spark, "none"), require=True)


def test_summary_stream_goes_on_after_a_restart(spark):
    messages, _ = feed.feed_run(provider_rows(spark), "r1")
    output = fresh_path(spark, "summary")
    for times in (1, 2):
        got = feed.run_summary_stream(feed.stream_files(spark, messages, 1), "r1", output).collect()
        assert {(r.provider_name, r.status): (r.event_count, r.total_issues) for r in got} == {
            (None, "failed"): (times, times), ("ProviderA", "failed"): (3 * times, 5 * times), ("ProviderA", "passed"): (times, 0)}
        more, _ = feed.feed_run(provider_rows(spark), "r1")
        feed.publish_files(spark.read.text(more), messages)


def test_messages_are_counted_by_the_write(spark, monkeypatch):
    """The manifest has the count of the write, without another read, for an empty feed as well."""
    monkeypatch.setattr(spark.read.__class__, "text", lambda *a, **k: pytest.fail("messages were read back"))
    for rows in (provider_rows(spark).repartition(3), provider_rows(spark).limit(0)):
        _, manifest = feed.feed_run(rows, "r2")
        assert feed.read_manifest(spark, manifest).first().published_count == rows.count()


def test_reports_with_many_rows_have_a_file_per_task(spark, tmp_path):
    df = spark.range(100).repartition(3).selectExpr("id", "array(id) AS list")
    many, one = (write_report(df, str(tmp_path / n), "csv", one_file=n == "one") for n in ("many", "one"))
    files = [len(spark.read.text(p).inputFiles()) for p in (many, one)]
    assert files == [3, 1] and read_csv(spark, many).count() == read_csv(spark, one).count() == 100


def test_blanks_survive_a_report_file(spark, tmp_path):
    df = spark.createDataFrame([(1, " "), (2, ""), (3, None), (4, " a "), (5, 'x\n"y"')], "id int, v string")
    path = write_report(df, str(tmp_path / "r"), "csv")
    # An empty value is a missing one in CSV files.
    want = [(i, v or None) for i, v in df.collect()]
    assert sorted((int(r.id), r.v) for r in read_csv(spark, path, na_tokens=()).collect()) == want
