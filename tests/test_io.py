"""Sources and sinks: dated publishing, JDBC reads (embedded Derby), lineage cuts,
and the driver contract."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001, rows
from customer360.plans.lineage import checkpoint_dir, cut_lineage
from customer360.sources.sinks import publish, with_report_label
from customer360.sources.tables import read_jdbc


def test_report_label(spark):
    df = spark.createDataFrame([(1,)], "client_id long")
    r = with_report_label(df, dt.date(2001, 8, 1), "report_b").collect()[0]
    assert (r["report_date"], r["report_name"]) == ("07-31-2001", "report_b_07-31-2001")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_publish_round_trip_and_day_replacement(spark, tmp_path, fmt):
    root = str(tmp_path)
    day1 = spark.createDataFrame([(1, "a"), (2, "b")], "Customer_ID long, Brand string")
    day2 = spark.createDataFrame([(3, "c")], "Customer_ID long, Brand string")
    path = publish(day1, dt.date(2001, 8, 1), "report_b", root, fmt)
    publish(day2, dt.date(2001, 8, 2), "report_b", root, fmt)
    publish(day2, dt.date(2001, 8, 1), "report_b", root, fmt)  # re-run of the first day
    assert sorted(os.path.basename(p) for p in glob.glob(path + "/report_date=*")) == [
        "report_date=07-31-2001", "report_date=08-01-2001"]
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").schema("Customer_ID long, Brand string, report_date string")
    back = reader.load(path)
    assert rows(back, "Customer_ID", "report_date") == [(3, "07-31-2001"), (3, "08-01-2001")]
    publish(day2.where("false"), dt.date(2001, 8, 1), "report_b", root, fmt)  # a report that became empty
    assert rows(reader.load(path), "Customer_ID", "report_date") == [(3, "08-01-2001")]


def test_jdbc_partitioned_read_embedded_derby(spark):
    url = "jdbc:derby:memory:c360test;create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = spark.range(0, 1000).select(
        F.col("id").alias("ID"), (F.col("id") % 7).alias("CLIENT_ID"), (F.col("id") * 1.5).alias("AMOUNT")
    )
    src.write.format("jdbc").option("url", url).option("dbtable", "TXNS").options(**opts).mode("overwrite").save()
    df = read_jdbc(spark, url, table="TXNS", partition_column="ID", lower_bound=0, upper_bound=1000,
                   num_partitions=4, options=opts)
    assert df.rdd.getNumPartitions() == 4
    agg = df.filter("CLIENT_ID = 3").agg(F.count("*").alias("n"), F.sum("AMOUNT").alias("s")).collect()[0]
    exp = src.filter("CLIENT_ID = 3").agg(F.count("*").alias("n"), F.sum("AMOUNT").alias("s")).collect()[0]
    assert tuple(agg) == tuple(exp)
    q = read_jdbc(spark, url, query="SELECT CLIENT_ID, COUNT(*) AS N FROM TXNS GROUP BY CLIENT_ID", options=opts)
    assert q.count() == 7
    with pytest.raises(ValueError):
        read_jdbc(spark, url, table="TXNS", partition_column="ID", options=opts)


def test_checkpoint_dir_respects_session_setting(spark):
    d = checkpoint_dir(spark)
    assert d
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.agg(F.sum("x")).collect()[0][0] == 90


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert len(df.columns) == 63 and df.count() > 0


def test_entry_contract_keys():
    from __spark_entry__ import oracle_sql, queries

    assert set(oracle_sql()) <= set(queries())
    assert len(oracle_sql()) >= 40


def test_queries_run_at_smallest_scale(spark):
    from customer360.catalog import QUERIES

    for k, q in QUERIES.items():
        q(spark, SF0001).write.format("noop").mode("overwrite").save()


def test_jobs_end_to_end(spark, tmp_path):
    from customer360.catalog import PARAMS_A, PARAMS_B
    from customer360.jobs import TABLES_A, TABLES_B, Inputs, job_a, run

    out = str(tmp_path / "out")
    ins_b = Inputs.from_fixtures(spark, SF0001, TABLES_B)
    path_b = run(spark, "b", ins_b, PARAMS_B, out)
    back_b = spark.read.parquet(path_b)
    assert "last_contact_turn" in back_b.columns and "email" not in back_b.columns
    assert back_b.count() > 0 and back_b.select("report_date").distinct().collect()[0][0] == "07-31-2001"

    # The same job over tables stored as datasets (one per logical table).
    tables = str(tmp_path / "tables")
    ins_a = Inputs.from_fixtures(spark, SF0001, TABLES_A)
    for n in TABLES_A:
        ins_a.tables[n].write.parquet(f"{tables}/{n}")
    stored = Inputs.from_dir(spark, tables, TABLES_A)
    assert rows(job_a(stored, PARAMS_A)) == rows(job_a(ins_a, PARAMS_A))
    path_a = run(spark, "a", stored, PARAMS_A, out, "csv")
    assert glob.glob(path_a + "/report_date=07-31-2001/v-*/*.csv")


def test_shuffle_partition_sizing():
    from customer360.plans.settings import shuffle_partitions_for

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 << 40) == 819_200  # 100 TB
    assert shuffle_partitions_for(10 << 30) == 80


@pytest.mark.parametrize("job", ["a", "b"])
def test_source_column_names_round_trip(spark, job):
    from customer360.catalog import PARAMS_A, PARAMS_B
    from customer360.jobs import TABLES_A, TABLES_B, Inputs, job_a, job_b
    from customer360.sources.source_schemas import JOB_A_COLUMNS, JOB_B_COLUMNS

    names, cols, run, p = ((TABLES_A, JOB_A_COLUMNS, job_a, PARAMS_A) if job == "a"
                           else (TABLES_B, JOB_B_COLUMNS, job_b, PARAMS_B))
    logical = Inputs.from_fixtures(spark, SF0001, names)
    # Store the tables under the source jobs' column names ...
    source = {}
    for n, df in logical.tables.items():
        back = {v: k for k, v in cols.get(n, {}).items()}
        source[n] = df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})
    assert source["customers"].columns != logical.tables["customers"].columns
    # ... and map them back: the job's result is unchanged.
    assert rows(run(Inputs.from_source(source, job), p)) == rows(run(logical, p))


def test_job_b_codes(spark):
    from customer360 import operators as ops
    from customer360.sources.source_schemas import job_b_params, to_logical

    tx = spark.createDataFrame(
        [(1, 7, 1, dt.datetime(2001, 7, 30, 10), 10.0, "DEPOSIT", "SUCCESSFUL"),
         (2, 7, 1, dt.datetime(2001, 7, 30, 11), 4.0, "WITHDRAWAL", "APPROVED"),
         (3, 7, 1, dt.datetime(2001, 7, 30, 12), 99.0, "DEPOSIT", "PENDING")],
        "id long, customer_fk long, currency_fk long, c_date timestamp_ntz, amount double, trx_type string, status string",
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    t = to_logical({"transactions": tx}, "b")["transactions"]
    r = ops.flow_horizons(t, job_b_params(dt.date(2001, 8, 1))).collect()[0]
    assert (r["deposit_7_days"], r["withdrawl_7_days"], r["total_deposits_count"]) == (10.0, 4.0, 1)


def test_flow_rollup_refresh_gives_same_report(spark, tmp_path):
    from customer360.catalog import PARAMS_A
    from customer360.jobs import TABLES_A, Inputs, job_a, refresh_flow_rollup

    ins = Inputs.from_fixtures(spark, SF0001, TABLES_A)
    path = str(tmp_path / "flow_rollup")
    refresh_flow_rollup(ins.transactions, PARAMS_A, path)                      # full build
    rollup = refresh_flow_rollup(ins.transactions, PARAMS_A, path, days_back=40)  # recent days only
    assert rollup.select("txn_date").distinct().count() > 40
    assert rows(job_a(ins, PARAMS_A, rollup)) == rows(job_a(ins, PARAMS_A))


def test_rollup_days_that_lose_all_rows(spark, tmp_path):
    from customer360.catalog import PARAMS_A
    from customer360.jobs import refresh_flow_rollup
    from customer360.sources.fixtures import Fixtures

    tx = Fixtures(spark, SF0001).transactions().where("txn_date >= date '2001-05-01' or txn_date is null")
    path = str(tmp_path / "rollup")
    recent = PARAMS_A.asof - dt.timedelta(days=60)
    days = tx.where((F.col("txn_date") >= F.lit(recent)) & F.col("status").isin(*PARAMS_A.approved_statuses)).select("txn_date").distinct()
    lost = days.orderBy(F.desc("txn_date")).first()[0]
    for back in (60, None):
        refresh_flow_rollup(tx, PARAMS_A, path)
        assert refresh_flow_rollup(tx, PARAMS_A, path, back).where(F.col("txn_date") == F.lit(lost)).count() > 0
        after = refresh_flow_rollup(tx.where((F.col("txn_date") != F.lit(lost)) | F.col("txn_date").isNull()), PARAMS_A, path, back)
        assert after.where(F.col("txn_date") == F.lit(lost)).count() == 0
        full = refresh_flow_rollup(tx.where((F.col("txn_date") != F.lit(lost)) | F.col("txn_date").isNull()), PARAMS_A, str(tmp_path / f"full{back}"))
        assert rows(after, *sorted(after.columns)) == rows(full, *sorted(full.columns))
    assert max(len(os.listdir(d)) for d in glob.glob(path + "/txn_date=*")) <= 2 * 8


def test_repeated_transaction_ids_are_an_error(spark):
    from customer360.catalog import PARAMS_A
    from customer360.jobs import require_unique_ids
    from customer360.sources.fixtures import Fixtures

    p = PARAMS_A
    tx = Fixtures(spark, SF0001).transactions()
    require_unique_ids(tx, p)
    deposits = tx.filter((F.col("txn_type") == p.deposit_type) & (F.col("status") == "Approved") & F.col("txn_date").isNotNull())
    old = deposits.orderBy("txn_date", "id").limit(1)
    with pytest.raises(ValueError, match="ids repeat, for example on"):
        require_unique_ids(tx.unionByName(old), p)
    # Another day, or a day that is not rebuilt, is no repeat.
    require_unique_ids(tx.unionByName(old.withColumn("txn_date", F.date_add("txn_date", 1))), p)
    require_unique_ids(tx.unionByName(old), p, days_back=30)


def test_rollup_raises_other_trouble(spark):
    from customer360.catalog import PARAMS_A
    from customer360.jobs import refresh_flow_rollup
    from customer360.sources.fixtures import Fixtures

    with pytest.raises(Exception, match="(?i)scheme"):
        refresh_flow_rollup(Fixtures(spark, SF0001).transactions(), PARAMS_A, "nosuchscheme://x/y", 3)


def test_table_paths_are_asked_of_their_file_system(spark, tmp_path):
    from customer360.sources.tables import TableSet

    spark.range(3).write.parquet(str(tmp_path / "one.parquet"))
    spark.range(4).write.parquet(str(tmp_path / "two"))
    for root in (str(tmp_path), f"file://{tmp_path}"):
        t = TableSet(spark, root)
        assert (t["one"].count(), t["two"].count()) == (3, 4)


def test_missing_source_columns_are_an_error(spark):
    from customer360.sources.source_schemas import to_logical

    with pytest.raises(ValueError, match="table currencies: missing columns: rate_to_eur"):
        to_logical({"currencies": spark.createDataFrame([(1, 1)], "id int, is_valid int")}, "b")


def test_columns_and_codes_of_another_kind_are_errors(spark):
    from dataclasses import replace

    from customer360.catalog import PARAMS_A, PARAMS_B
    from customer360.jobs import TABLES_A, TABLES_B, Inputs, job_a, job_b
    from customer360.sources.source_schemas import check_columns

    a, b = Inputs.from_fixtures(spark, SF0001, TABLES_A), Inputs.from_fixtures(spark, SF0001, TABLES_B)
    check_columns(a.tables, PARAMS_A)
    check_columns(b.tables, PARAMS_B)
    with pytest.raises(ValueError, match="txn_type is int, but its code is 'DEPOSIT'"):
        job_b(b, replace(PARAMS_B, deposit_type="DEPOSIT", withdrawal_type="WITHDRAWAL"))
    text = a.transactions.withColumn("amount", F.col("amount").cast("string")).withColumn("txn_date", F.col("txn_date").cast("string"))
    with pytest.raises(ValueError, match="transactions.amount is string, not a number; transactions.txn_date is string, not a day"):
        job_a(Inputs({**a.tables, "transactions": text}), PARAMS_A)


def test_database_tables_feed_job_a(spark, tmp_path):
    from customer360.catalog import PARAMS_A
    from customer360.jobs import TABLES_A, Inputs, job_a
    from customer360.sources.source_schemas import JOB_A_COLUMNS

    url, driver = "jdbc:derby:memory:c360jobs;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    ins = Inputs.from_fixtures(spark, SF0001, TABLES_A)
    options = {}
    for n in TABLES_A:
        back = {v: k for k, v in JOB_A_COLUMNS[n].items()}
        df = ins.tables[n]
        if "email" in df.columns:
            df = df.withColumn("email", F.coalesce("email", F.lit("none")))
        text = [c for c, t in df.dtypes if t == "string"]
        out = df.withColumnsRenamed({c: back[c] for c in df.columns if c in back}).write.format("jdbc").option("url", url).option("dbtable", n).option("driver", driver)
        if text:  # an empty list of column types is a syntax error
            out = out.option("createTableColumnTypes", ", ".join(f"`{back.get(c, c)}` VARCHAR(200)" for c in text))
        out.mode("overwrite").save()
        options[n] = {"url": url, "table": n, "options": {"driver": driver}}
    stored = Inputs.from_jdbc(spark, options, "a")
    got, want = job_a(stored, PARAMS_A), job_a(ins, PARAMS_A)
    same = [c for c in want.columns if c != "Email"]
    assert rows(got, *same) == rows(want, *same)


def test_job_cli(spark, tmp_path, capsys):
    from customer360.jobs import main

    out = str(tmp_path / "out")
    main(["--report", "a", "--fixtures", SF0001, "--out", out, "--asof", "2001-08-01",
          "--vip-min-amount", "1000000", "--vip-min-count", "5", "--unique-ids",
          "--flow-rollup", str(tmp_path / "rollup"), "--rollup-days", "30", "--format", "csv"])
    main(["--report", "b", "--fixtures", SF0001, "--out", out, "--asof", "2001-08-01",
          "--crossing-amount", "300000"])
    printed = capsys.readouterr().out.split()
    assert printed[-2].endswith("/report_a") and printed[-1].endswith("/report_b")
    assert spark.read.parquet(printed[-1]).count() > 0
    assert glob.glob(printed[-2] + "/report_date=07-31-2001/v-*/*.csv")
    from customer360.catalog import report_a

    published = spark.read.option("header", "true").csv(printed[-2])
    assert published.count() == report_a(spark, SF0001).count() > 0
