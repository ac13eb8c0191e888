"""What keeps queries within the disk and memory of large tables: keys as numbers, pairs in parts, stage tables that go."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.functions.variants import osa, typo
from kinweave.operators import blocking, golden, graph, matching, vectors
from kinweave.plans.resolution import numbered
from kinweave.runtime import CLEANUP, discard, materialize


def test_a_stage_table_goes_and_leaves_the_setting_alone(spark):
    before = spark.conf.get(CLEANUP, None)
    table = materialize(spark.range(10), "gone")
    folder = table._stage.removeprefix("file://")
    assert os.path.isdir(folder) and spark.conf.get(CLEANUP, None) == before
    discard(table, spark.range(3))
    assert not os.path.isdir(folder)


def test_numbers_have_the_order_of_the_keys_or_are_left_out(spark):
    keys = ["00" * 32, "7f" + "ff" * 31, "80" + "00" * 31, "ff" * 32, "0123456789abcdef" + "00" * 24]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select(F.unhex("k").alias("record_key"))
    assert [r.k for r in numbered(rows).orderBy("record_key").select(F.lower(F.hex("key")).alias("k")).collect()] == sorted(keys)
    twins = rows.union(spark.createDataFrame([("00" * 31 + "01",)], "k string").select(F.unhex("k")))
    assert numbered(twins).schema["record_key"].dataType.typeName() == "binary"


def test_groups_of_numbers_beyond_doubles(spark):
    a = (1 << 62) + 1
    records = spark.createDataFrame([(a, None), (a + 1, None), (a + 2, None)], "record_key long, dob_usable date")
    edges = spark.createDataFrame([(a, a + 1, 0.9), (a + 1, a + 2, 0.8)], "left_record_key long, right_record_key long, score double")
    bans = spark.createDataFrame([(a, a + 2)], "left_record_key long, right_record_key long")
    mapping, refused = graph.constrained_components(records, edges, bans)
    assert {tuple(r) for r in mapping.collect()} == {(a, a), (a + 1, a), (a + 2, a + 2)}
    assert [tuple(r) for r in refused.collect()] == [(a + 1, a + 2, graph.LINK_VETO)]


def test_parts_are_all_pairs_once(spark):
    text = lambda n: F.concat(F.lit("v"), (F.col("id") % n).cast("string"))
    base = materialize(spark.range(300).select(
        F.sha2(F.col("id").cast("string"), 256).alias("record_key"), (F.col("id") % 3).cast("string").alias("source_system"), text(11).alias("given_name_n"), text(7).alias("family_name_n"), text(150).alias("email_n"), text(100).alias("phone_n"),
        text(40).alias("work_email_n"), text(41).alias("work_phone_n"), text(30).alias("home_address_n"), text(2).alias("work_address_n"), text(9).alias("postcode_n"), F.lit(None).cast("date").alias("dob_usable")), "base")
    whole = sorted(map(str, blocking.met_pairs(base, ["email_n"]).collect()))
    for parts in (3, None):
        split = blocking.met_parts(base, ["email_n"], parts=parts)
        assert len(split) == (parts or 9)
        assert sorted(str(r) for p in split for r in p.collect()) == whole


def test_typos_by_swaps_equal_the_edit_distance_without_python(spark):
    random.seed(7)
    rows = [("ca", "abc"), ("cabbbbbb", "abcbbbbb"), ("abcdefgh", "badcefgh"), ("abcdefgh", "bacdefhg"), ("abc", "acb")]
    for _ in range(3000):
        a = "".join(random.choices("abc", k=random.randint(0, 11)))
        b = list(a)
        for _ in range(random.randint(0, 3)):
            i = random.randrange(len(b) + 1)
            b[i : i + 2] = random.choice([b[i : i + 2][::-1], b[i + 1 : i + 2], ["c", *b[i : i + 2]]])
        rows.append((a, "".join(b)))
    told = spark.createDataFrame(rows, "a string, b string").select("a", "b", typo(F.col("a"), F.col("b")).alias("t"))
    assert "Python" not in told._jdf.queryExecution().toString()
    for a, b, t in told.collect():
        assert t == (min(len(a), len(b)) >= 3 and osa(a, b) <= (1 if max(len(a), len(b)) < 8 else 2)), (a, b)


def _vectors(spark, n, size=8):
    random.seed(3)
    rows = [(i, [round(random.uniform(-1, 1), 1) for _ in range(size)]) for i in range(n)]
    rows += [(n, rows[0][1]), (n + 1, None), (None, rows[0][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_exact_neighbours_are_not_shuffled_by_pairs_of_blocks(spark):
    rows, frame = _vectors(spark, 700)
    found = vectors.knn(frame, frame, 5, block=64)
    held = [(i, np.array(np.array(v, np.float32), np.float64)) for i, v in rows if i is not None and v is not None]
    ids, m = np.array([i for i, _ in held]), np.stack([v for _, v in held])
    score = np.round(m @ m.T, 6)
    want = set()
    for at, i in enumerate(ids):
        order = [j for j in np.lexsort((ids, -score[at])) if ids[j] != i][:5]
        want |= {(int(i), int(ids[j]), float(score[at, j]), r) for r, j in enumerate(order, 1)}
    assert {(r.query_id, r.neighbour_id, r.score, r["rank"]) for r in found.collect()} == want
    assert "Exchange" not in found._jdf.queryExecution().toString()


def test_a_part_of_the_index_gives_no_rank():
    block = {"q": [0], "q_ids": [[1]], "q_matrix": [np.ones(2).tobytes()], "ids": [[2, 3]], "matrix": [np.ones((2, 2)).tobytes()]}
    rows = pa.record_batch(block, pa.schema([("q", pa.int64()), ("q_ids", pa.list_(pa.int64())), ("q_matrix", pa.binary()), ("ids", pa.list_(pa.int64())), ("matrix", pa.binary())]))
    told = lambda blocks: [r["rank"] for b in vectors._nearest(2, 6, blocks)(iter([rows])) for r in b.to_pylist()]
    assert told(1) == [1, 2] and told(2) == [None, None]


def test_vectors_become_a_matrix_without_objects():
    held = pa.array([[9.0, 9.0], [1.0, 2.0], [3.0, 4.0]], pa.list_(pa.float32()))
    assert vectors._matrix(held.slice(1), np.float64).tolist() == [[1.0, 2.0], [3.0, 4.0]]
    assert len(vectors._matrix(held.slice(3), np.float32)) == 0
    with pytest.raises(ValueError, match="sizes"):
        vectors._matrix(pa.array([[1.0], [1.0, 2.0, 3.0]], pa.list_(pa.float32())), np.float32)


def test_a_customer_is_summed_up_in_one_shuffle(spark):
    columns = ["full_name", "given_name", "family_name", "company_name", *[f"{c}_n" for c in ("personal_email", "personal_phone", "work_email", "work_phone")], *[f"{k}_{c}" for k in ("home", "work") for c in (*golden.ADDRESS.values(), "address_n")]]
    value = lambda c: F.when(F.xxhash64(F.lit(c), "id") % 3 != 0, F.concat(F.lit(c[:2]), F.col("id") % 5)).when(F.col("id") % 2 == 0, "")
    contacts = spark.range(60).select(
        F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("record_key"), F.concat(F.lit("s"), F.col("id") % 3).alias("source_system"), F.when(F.col("id") % 4 > 0, F.timestamp_seconds(F.col("id") % 7)).alias("source_updated_at"),
        (F.col("id") % 3 * 10).cast("int").alias("source_priority"), F.when(F.col("id") % 2 > 0, F.date_add(F.lit("1990-01-01"), F.col("id").cast("int"))).alias("dob_usable"), *[value(c).alias(c) for c in columns])
    mapping = contacts.select("record_key", F.concat(F.lit("c"), F.pmod(F.xxhash64("record_key"), F.lit(9))).alias("customer_id"))
    rules = golden.survivorship_rules(spark.createDataFrame([("company_name", "priority")], "field string, ordering string"), spark)
    picked = golden.survivors(golden.field_candidates(mapping, contacts), rules)
    sums = golden.customer_summaries(golden.customer_rows(mapping, contacts), rules)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(picked, golden.summary_survivors(sums)) and same(golden.golden_profiles(picked, mapping, contacts), golden.summary_profiles(sums))
    rows = materialize(golden.customer_rows(mapping, contacts), "rows")
    assert golden.customer_summaries(rows, rules)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_a_models_sums_are_stage_tables_so_that_their_shuffles_go(spark, monkeypatch):
    made = []
    monkeypatch.setattr(matching, "materialize", lambda df, label: made.append(label) or materialize(df, label))
    records = spark.range(40).select(F.col("id").cast("string").alias("record_key"), *[F.concat(F.lit(c), F.col("id") % 9).alias(c) for c in matching.COMPARISONS])
    matching.fuzzy_u(records, 100)
    assert made == ["sums"]
