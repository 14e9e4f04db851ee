"""Relational operators: arg-max, keep-first, profile, union, sort, top-k,
flatten, upsert, surrogate key, skew-safe join, validation."""

import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from loanmart.operators.combine import rename, rename_positional, select_existing, union_all_by_name
from loanmart.operators.dedupe import distinct_values, keep_first
from loanmart.operators.latest import last_match, latest_by_numeric_id, latest_report_id
from loanmart.operators.nested import DRAW_ROW_COLUMNS, flatten_draws
from loanmart.operators.ordering import sort_nulls_last, top_k
from loanmart.operators.profile import duplicate_groups, extract_profile
from loanmart.operators.surrogate import add_surrogate_key
from loanmart.operators.upsert import DuplicateKeyError, data_table, rebucket, upsert, upsert_table
from loanmart.operators.validate import (
    ValidationError, assert_no_error_documents, assert_not_null, assert_pages_complete, require_columns,
)
from loanmart.sources.documents import read_draws
from loanmart.sources.sinks import append_table, replace_table
from loanmart.sources.tables import warehouse_table


def test_latest_is_numeric_not_text(spark):
    cat = spark.createDataFrame([("9", "Maturity Dates"), ("10", "Maturity Dates"), ("7", "Watchlist Report"),
                                 (None, "Watchlist Report")], "id string, name string")
    got = {r.name: r.id for r in latest_by_numeric_id(cat).collect()}
    assert got == {"Maturity Dates": "10", "Watchlist Report": "7"}
    assert latest_report_id(cat, "Maturity Dates") == "10"
    with pytest.raises(LookupError):
        latest_report_id(cat, "AccountingAllActiveLoans")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        latest_by_numeric_id(cat.unionByName(cat.limit(1).withColumn("id", F.lit("x")))).collect()


def test_last_match_wins(spark):
    df = spark.createDataFrame([(0, "a", "1"), (1, "a", "2"), (2, "b", "3")], "pos int, name string, id string")
    assert {r.name: r.id for r in last_match(df, ["name"], "id", "pos").collect()} == {"a": "2", "b": "3"}


def test_keep_first_newest_run_wins(spark):
    df = spark.createDataFrame(
        [("r1", "d1", "l1", "s", 1), ("r3", "d1", "l1", "s", 3), ("r2", None, "l1", "s", 2), ("r4", None, "l1", "s", 4)],
        "run string, draw_id string, loan_id string, st string, x int")
    got = sorted(keep_first(df, ["draw_id", "loan_id", "st"], "run").collect(), key=lambda r: r.run)
    assert [(r.run, r.x) for r in got] == [("r3", 3), ("r4", 4)]
    assert keep_first(df, ["draw_id"], "run").columns == df.columns
    assert sorted(r.draw_id for r in distinct_values(df, "draw_id").collect()) == ["d1"]


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    p = extract_profile(df).first().asDict()
    assert p == {"rows": 6, "nulls_k": 0, "nulls_v": 2, "duplicate_rows": 3, "distinct_rows": 3}
    assert sorted((r.k, r.n) for r in duplicate_groups(df).collect()) == [(1, 3), (2, 2)]


def test_union_rename_select(spark):
    a = spark.createDataFrame([(1, "x")], "A int, B string")
    b = spark.createDataFrame([("y", 2)], "OTHER string, A int")
    u = union_all_by_name([a, rename(b, {"OTHER": "B", "ABSENT": "Z"})])
    assert sorted(tuple(r) for r in u.collect()) == [(1, "x"), (2, "y")]
    assert union_all_by_name([a, b.select("A")]).where("A = 2").first().B is None
    assert rename_positional(a, ["p", "q"]).columns == ["p", "q"]
    with pytest.raises(ValueError):
        rename_positional(a, ["p"])
    assert select_existing(a, ["B", "NOPE", "A"]).columns == ["B", "A"]


def test_sort_nulls_last_and_top_k(spark):
    df = spark.createDataFrame([(None, "b"), (2, None), (1, "z"), (1, "a")], "d int, f string")
    assert [tuple(r) for r in sort_nulls_last(df, ["d", "f"]).collect()] == [(1, "a"), (1, "z"), (2, None), (None, "b")]
    assert [r.d for r in top_k(df, "d", 2).collect()] == [2, 1]


def _draw_docs(tmp):
    docs = [
        {"id": 11, "type": "Standard", "name": "D11", "lineItems": {"payee": {
            "Acme": {"items": [[{"number": "1", "requested": "10.00"}, {"number": "2", "requested": "5.00"}],
                               [{"number": "3", "requested": "1.00"}]]},
            "Bolt": {"items": [[]]}}}},
        {"id": 12, "type": None, "lineItems": {"payee": {}}},
        {"id": 13, "type": "Standard", "lineItems": json.dumps({"payee": {"Cray": {"items": [[{"number": "9"}]]}}})},
    ]
    path = f"{tmp}/draws"
    import os
    os.makedirs(path)
    for d in docs:
        with open(f"{path}/{d['id']}.json", "w") as f:
            json.dump(d, f)
    return path


def test_flatten_draws_struct_and_text(spark, tmpdir_path):
    path = _draw_docs(tmpdir_path)
    typed = flatten_draws(read_draws(spark, f"{path}/1[12].json"))
    assert tuple(typed.columns) == DRAW_ROW_COLUMNS
    rows = sorted((r["draw_id"], r["payee.name"], r["lineItems.number"], r["lineItems.amount"]) for r in typed.collect())
    assert rows == [("11", "Acme", "1", "10.00"), ("11", "Acme", "2", "5.00"), ("11", "Acme", "3", "1.00")]
    text = flatten_draws(read_draws(spark, f"{path}/13.json", line_items_as_text=True))
    assert [(r["draw_id"], r["payee.name"], r["lineItems.number"]) for r in text.collect()] == [("13", "Cray", "9")]


def test_upsert_matches_merge_and_is_idempotent(spark):
    target = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    source = spark.createDataFrame([("2", "B"), ("3", "c")], "id string, v string")
    once = upsert(target, source, ["id"])
    assert sorted(tuple(r) for r in once.collect()) == [("1", "a"), ("2", "B"), ("3", "c")]
    twice = upsert(once, source, ["id"])
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())
    dup = spark.createDataFrame([("2", "x"), ("2", "y")], "id string, v string")
    with pytest.raises(DuplicateKeyError):
        upsert(target, dup, ["id"])
    latest = upsert(target, dup.withColumn("seq", F.monotonically_increasing_id()), ["id"],
                    on_duplicate="latest", order_col="seq")
    assert sorted(tuple(r) for r in latest.collect()) == [("1", "a"), ("2", "y")]


def test_surrogate_key_matches_row_number_across_partitions(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("name"),
                                     (F.col("id") % 3).alias("grp"))
    got = add_surrogate_key(df, ["name"], partitions=7)
    want = df.withColumn("unique_id", F.row_number().over(Window.orderBy("name", "grp")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.select(F.min("unique_id"), F.max("unique_id")).first() == (1, 5000)


def test_validations(spark):
    df = spark.createDataFrame([("1", None)], "id string, name string")
    require_columns(df, ["id"])
    with pytest.raises(ValidationError):
        require_columns(df, ["loan_id"])
    with pytest.raises(ValidationError):
        assert_not_null(df, ["id", "name"])
    pages = spark.createDataFrame([("c1", ["a", "b"], 3), ("c1", ["c"], 3), ("c2", ["d"], 2)],
                                  "companyId string, content array<string>, total int")
    with pytest.raises(ValidationError, match="c2"):
        assert_pages_complete(pages, ["companyId"], total_col="total")
    assert_pages_complete(pages.where("companyId = 'c1'"), ["companyId"], total_col="total")
    errs = spark.createDataFrame([(None, None), ("invalid_token", "expired")], "error string, error_description string")
    with pytest.raises(ValidationError, match="expired"):
        assert_no_error_documents(errs)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_surrogate_key_without_exchange_reuse(spark, adaptive):
    before = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        df = spark.range(30_000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v")).repartition(11)
        got = add_surrogate_key(df, ["k"])
        assert got.agg(F.count_distinct("unique_id"), F.min("unique_id"), F.max("unique_id")).first() == (30_000, 1, 30_000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_keep_first_with_null_and_tied_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 5, 1), ("b", 5, 3), ("b", None, 9), (None, 1, 7)], "k string, o int, v int")
    assert sorted(map(tuple, keep_first(df, ["k"], "o").collect()), key=str) == [("a", None, 2), ("b", 5, 3), (None, 1, 7)]
    assert sorted(map(tuple, keep_first(df, ["k"], "o", descending=False).collect()), key=str) == [("a", None, 1), ("b", 5, 1), (None, 1, 7)]


def test_transaction_report_needs_the_account(spark):
    from loanmart.operators.validate import ValidationError
    from loanmart.plans.transactions import transaction_report
    with pytest.raises(ValidationError, match="account_id"):
        transaction_report(spark.createDataFrame([("1",)], "id string"), spark.createDataFrame([("x",)], "loanNumber string"), __import__("datetime").date(2024, 1, 1))


def test_local_scratch_is_refused_on_a_cluster(spark, monkeypatch):
    from loanmart import session
    context = type("C", (), {"getCheckpointDir": lambda s: None, "getConf": lambda s: {}, "master": "spark://host:7077"})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(type("S", (), {"sparkContext": context})())


def _files(spark, table):
    """Data files of a table by bucket."""
    out = {}
    for r in spark.table(data_table(table)).select("_bucket", F.input_file_name().alias("f")).distinct().collect():
        out.setdefault(r["_bucket"], set()).add(r["f"])
    return out


def test_upsert_table_rewrites_touched_buckets_only(spark):
    name = f"t_{uuid.uuid4().hex}"
    rows = spark.range(2000).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"))
    upsert_table(spark, name, rows, ["id"], buckets=20)
    before = _files(spark, name)
    change = spark.createDataFrame([(5, "new"), (5000, "more")], "id long, v string")
    upsert_table(spark, name, change, ["id"])
    after = _files(spark, name)
    touched = {r["_bucket"] for r in spark.table(data_table(name)).where("id IN (5, 5000)").collect()}
    assert len(before) == 20 and {b for b in after if after[b] != before.get(b)} == touched
    assert spark.table(name).columns == ["id", "v"]
    got = {r.id: r.v for r in warehouse_table(spark, name).collect()}
    assert got == {i: f"v{i}" for i in range(2000)} | {5: "new", 5000: "more"}
    # run again, as after a crash: nothing changes; no rows touch nothing
    upsert_table(spark, name, change, ["id"])
    upsert_table(spark, name, change.limit(0), ["id"])
    assert {r.id: r.v for r in warehouse_table(spark, name).collect()} == got
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, name, change.unionByName(change), ["id"])
    with pytest.raises(ValueError):
        upsert_table(spark, name, change, ["v"])
    upsert_table(spark, name, spark.createDataFrame([(5, "a", 1), (5, "b", 2)], "id int, v string, seq int"), ["id"], on_duplicate="latest", order_col="seq")
    assert warehouse_table(spark, name).where("id = 5").first().v == "b"
    rebucket(spark, name, ["id"], 7)
    assert len(_files(spark, name)) == 7 and warehouse_table(spark, name).count() == 2001
    upsert_table(spark, name, spark.createDataFrame([(6, "six")], "id long, v string"), ["id"])
    assert warehouse_table(spark, name).where("v = 'six'").count() == 1


def test_upsert_table_with_null_and_repeated_target_keys(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.createDataFrame([(None, "n"), (1, "a"), (1, "b"), (2, "c"), (2, "d")], "id long, v string").write.saveAsTable(name)
    rebucket(spark, name, ["id"], 3)
    upsert_table(spark, name, spark.createDataFrame([(2, "x"), (None, "m")], "id long, v string"), ["id"])
    got = sorted((str(r.id), r.v) for r in warehouse_table(spark, name).collect())
    assert got == [("1", "a"), ("1", "b"), ("2", "x"), ("None", "m"), ("None", "n")]


def test_a_load_run_again_counts_once(spark):
    name = f"t_{uuid.uuid4().hex}"
    day = datetime.datetime(2024, 1, 15)
    first = spark.createDataFrame([("LN-1", 1), ("", 2), (None, 3)], "loan_number string, n int")
    append_table(spark, first, name, day, "load '1'")
    append_table(spark, first.where("n = 1"), name, day, "load '2'")
    append_table(spark, first.limit(0), name, day, "load '2'")
    append_table(spark, first, name, day + datetime.timedelta(hours=1), "load '1'")
    append_table(spark, first.select("n").where("n = 3"), name, day, "3")
    got = warehouse_table(spark, name)
    assert sorted((r.loan_number or "", r.n) for r in got.collect()) == [("", 3), ("", 3), ("LN-1", 1)]
    assert got.columns == ["loan_number", "n", "upload_date"]
    with pytest.raises(ValueError):
        append_table(spark, first.withColumn("more", F.lit(1)), name, day)
    replace_table(spark, name, "a INT")
    assert warehouse_table(spark, name).columns == ["a"] and warehouse_table(spark, name).count() == 0
