"""The engine's operators against plain Python."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinweave.functions import text as norm
from kinweave.functions.variants import dob_variant, family_variant, given_variant, osa
from kinweave.operators import blocking, generate, golden, graph, matching, population, profile, publication, release, review, skew, steward, tables, vectors
from kinweave.operators.components import connected_components
from kinweave.plans.queries import QUERIES
from kinweave.runtime import materialize
from kinweave.sources.guests import truth_like
from kinweave.sources.reference import read_reference, render, statements

SF = "/root/testdata/sf0.001"


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text_forms(spark):
    assert column(spark, ["  José-Luis O'Neil ", "ﬁne  Ｔext", "", None, " ~ ", "a_b c"], norm.text) == ["jose luis o neil", "fine text", None, None, None, "a_b c"]
    assert column(spark, ["12 High Street", "Apartment 3 King  Court"], norm.address) == ["12 high st", "unit 3 king ct"]
    mails = ["A.B+c@Gmail.com", "a.b@googlemail.com", "a.b+c@x.io", "guest-1@x.io", "guests@x.io", "no at", "a@b", None]
    assert column(spark, mails, norm.email) == ["ab@gmail.com", "ab@gmail.com", "a.b+c@x.io", None, "guests@x.io", None, None, None]
    assert column(spark, ["+61 412 345 678", "(04) 1234 5678", "0061412345678", "12", None], norm.phone) == ["+61412345678", "+61412345678", "+61412345678", None, None]


def test_variants(spark):
    day = dt.date
    dates = [(day(1990, 2, 3), day(1990, 2, 3), "EXACT"), (day(1990, 2, 3), day(1990, 3, 2), "DAY_MONTH_SWAP"), (day(1990, 2, 3), day(1980, 2, 3), "YEAR_DIGIT"), (day(1990, 2, 3), day(1990, 2, 13), "DAY_DIGIT"), (day(1990, 2, 3), day(1991, 3, 2), "CONFLICT"), (None, day(1990, 1, 1), None)]
    frame = spark.createDataFrame(dates, "a date, b date, want string")
    assert all(r.want == r.got for r in frame.withColumn("got", dob_variant(F.col("a"), F.col("b"))).collect())
    names = [("will", "bill", "NICKNAME"), ("jo", "jo ann", "EXACT"), ("j", "john", "INITIAL"), ("chris", "christine", "PREFIX"), ("marta", "matra", "TYPO"), ("anna", "zoe", "CONFLICT"), (None, "a", None)]
    frame = spark.createDataFrame(names, "a string, b string, want string")
    assert all(r.want == r.got for r in frame.withColumn("got", given_variant(F.col("a"), F.col("b"))).collect())
    names = [("o neil", "oneil", "EXACT"), ("smith jones", "jones", "TOKEN"), ("kowalski", "kowlaksi", "TYPO"), ("brown", "green", "CONFLICT"), ("a", None, None)]
    frame = spark.createDataFrame(names, "a string, b string, want string")
    assert all(r.want == r.got for r in frame.withColumn("got", family_variant(F.col("a"), F.col("b"))).collect())


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=6), st.text("abc", max_size=6))
def test_osa_is_a_bounded_distance(a, b):
    assert osa(a, b) == osa(b, a) and abs(len(a) - len(b)) <= osa(a, b) <= max(len(a), len(b)) and (osa(a, b) == 0) == (a == b)


def test_osa_values():
    assert [osa("ca", "abc"), osa("ab", "ba"), osa("", "xy")] == [3, 1, 2]


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed, monkeypatch):
    """Round by round, and with the rest joined by a task."""
    from kinweave.operators import components

    monkeypatch.setattr(components, "FINISH", (0, 0, 20, 1 << 14)[seed])
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def whole_graph(keys, edges, dobs, denied, size):
    """The greedy order over all edges at once."""
    return graph.merge([*edges, *[(k, k, -1.0) for k in keys]], dobs, denied, size)


def test_constrained_groups_by_component_equal_the_whole(spark):
    rng = random.Random(5)
    keys = [f"k{i:03d}" for i in range(90)]
    edges = sorted({tuple(sorted(rng.sample(keys, 2))) for _ in range(80)})
    edges = [(a, b, round(rng.random(), 1)) for a, b in edges]
    dobs = {k: rng.choice([None, None, dt.date(1990, 1, 2), dt.date(1990, 2, 1), dt.date(1980, 5, 5)]) for k in keys}
    bans = [tuple(sorted(rng.sample(keys, 2))) for _ in range(30)]
    denied = {}
    for a, b in bans:
        denied.setdefault(a, set()).add(b)
        denied.setdefault(b, set()).add(a)
    want, refused = whole_graph(keys, edges, dobs, denied, 6)
    mapping, got = graph.constrained_components(
        spark.createDataFrame(list(dobs.items()), "record_key string, dob_usable date"), spark.createDataFrame(edges, "left_record_key string, right_record_key string, score double"),
        spark.createDataFrame(bans, "left_record_key string, right_record_key string"), 6)
    assert {r.record_key: r.component for r in mapping.collect()} == want
    assert {tuple(r) for r in got.collect()} == set(refused) and refused
    groups = {}
    for k, g in want.items():
        groups.setdefault(g, []).append(k)
    for members in groups.values():
        assert len(members) <= 6 and not any(b in denied.get(a, ()) for a in members for b in members)


def test_persistent_ids(spark):
    mapping = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("d", "d")], "record_key string, component string")
    old = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "record_key string, customer_id string")
    born = spark.createDataFrame([("x", "2020"), ("y", "2019"), ("z", "2021")], "customer_id string, created_at string")
    ids, aliases = graph.persistent_ids(mapping, old, born, "r")
    got = {r.record_key: r.customer_id for r in ids.collect()}
    assert got["a"] == got["b"] == "y" and got["c"] == "z" and got["d"].startswith("cus_") and len(got["d"]) == 32
    assert [tuple(r) for r in aliases.collect()] == [("x", "y")]


def test_model_arithmetic():
    rows = [((3, 1, -1, 1, 3), 40), ((0, 0, 0, 0, 0), 900), ((3, 0, 1, 1, -1), 25), ((1, 0, 0, 0, 2), 60)]
    u = {c: [0.9] + [0.1 / (matching.levels(c) - 1)] * (matching.levels(c) - 1) for c in matching.COMPARISONS}
    m = matching.em(rows, u, ("personal_email_n",))
    assert "personal_email_n" not in m and all(abs(sum(p) - 1) < 1e-9 for p in m.values()) and m["dob_usable"][1] > m["dob_usable"][0]
    assert abs(sum(matching.smooth([0.0, 1.0], 10)) - 1) < 1e-12
    with pytest.raises(ValueError):
        matching.smooth([1.5], 1)


def test_versions_and_fingerprint(spark, tmp_path):
    v = tables.Versions(spark, f"file://{tmp_path}")
    n = spark.read.parquet(f"{SF}/nation.parquet")
    assert not v.exists("n") and v.write("n", n) == 0 and v.write("n", n.limit(3)) == 1
    assert v.read("n").count() == 3 and v.read("n", 0).count() == 25 and v.latest("n") == 1
    assert tables.fingerprint(n) == tables.fingerprint(n.orderBy(F.desc("n_name"))) != tables.fingerprint(n.limit(24))
    v.freeze("f", n)
    assert v.freeze("f", n.orderBy("n_name")) == 0
    with pytest.raises(ValueError):
        v.freeze("f", n.limit(1))


def test_reference_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,,2.5\n,q,\n")
    got = [tuple(r) for r in read_reference(spark, f"file://{tmp_path}/x.csv", {"b": "STRING", "a": "BIGINT", "c": "DOUBLE"}).collect()]
    assert got == [("", 1, 2.5), ("q", None, None)]
    with pytest.raises(ValueError):
        read_reference(spark, f"file://{tmp_path}/x.csv", {"z": "INT"})
    assert render("a {{b}}", {"b": "1"}) == "a 1" and statements("SELECT 1;\n-- COMMAND ----------\nSELECT 2") == ["SELECT 1", "SELECT 2"]
    with pytest.raises(ValueError):
        render("{{c}}", {})


def test_review_rules(spark):
    rows = [(["a", "b"], [["a"], ["b"]], "SEPARATE", None), (["a", "b"], [["a", "b"]], "MERGE", None), (["a", "b"], [["a"]], "DEFER", "not every record exactly once"), (["a", "b", "c"], [["a"], ["b"], ["c"]], "PARTITION", "a partition has between one and all"), (["a"], [["a"]], "X", "no such action")]
    frame = spark.createDataFrame(rows, "m array<string>, g array<array<string>>, action string, want string")
    assert all(r.want == r.got for r in frame.withColumn("got", review.partition_problem(F.col("m"), F.col("g"), F.col("action"))).collect())
    good = {"links": {"table": "a.b.links", "version": 1, "row_count": 2}}
    assert review.parse_manifest(good, {"links": r"[a-z.]+"}) == good
    with pytest.raises(ValueError):
        review.parse_manifest({"links": {"table": "a.b.links", "version": -1, "row_count": 2}}, {"links": r"[a-z.]+"})
    assert truth_like(["name", "truth_person_id", "Expected_x"]) == ["truth_person_id", "Expected_x"]


def test_outbox_lands_once(spark, tmp_path):
    import json

    from kinweave.streaming.outbox import EVENT_SCHEMA, land_once, read_outbox

    (tmp_path / "in").mkdir()
    event = {"event_id": "e1", "case_id": "c", "applied_case_version": 1, "action": "MERGE", "content_digest": "d", "memberships": [{"record_key": "r", "customer_id": "x"}]}
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(event) + "\n")
        land_once(read_outbox(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/log", f"file://{tmp_path}/cp").awaitTermination(60)
    assert spark.read.schema(EVENT_SCHEMA).parquet(f"file://{tmp_path}/log").count() == 1
    both = [event | {"event_id": "e2"}, event | {"event_id": "e2", "content_digest": None}]
    for name, rows in (("c", [event | {"content_digest": None}]), ("d", both)):  # other content in the log, and in one batch
        folder = tmp_path / f"in-{name}"
        folder.mkdir()
        (folder / "x.json").write_text("\n".join(map(json.dumps, rows)))
        with pytest.raises(Exception, match="other content"):
            land_once(read_outbox(spark, f"file://{folder}"), f"file://{tmp_path}/log", f"file://{tmp_path}/cp-{name}").awaitTermination(60)
    assert spark.read.schema(EVENT_SCHEMA).parquet(f"file://{tmp_path}/log").count() == 1


@pytest.mark.parametrize("data", ["fixture", "sf"])
def test_components_query_reads_every_edge(spark, tmp_path, data):
    from kinweave.plans.queries import QUERIES

    folder = SF
    if data == "fixture":
        folder = str(tmp_path)
        rows = [(51, 1, 1), (51, 2, 1), (7, 2, 2), (50, 3, 3), (99, 4, 3), (100, 5, 4), (3, None, 9), (3, 5, 4)]
        spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    edges = [(r[0], -r[1]) for r in spark.read.parquet(f"{folder}/lineitem.parquet").select("l_partkey", "l_suppkey").collect() if r[0] is not None and r[1] is not None]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = QUERIES["connected_components"](spark, folder).collect()
    assert len(got) == len(parent) and {r.node: r.component for r in got} == {x: root(x) for x in parent}


def test_json_and_case_reads_every_event(spark):
    duckdb = pytest.importorskip("duckdb")
    from kinweave.plans.queries import ORACLE_SQL, QUERIES

    con, name = duckdb.connect(), "json_and_case"
    con.execute(f"CREATE VIEW events AS FROM read_parquet('{SF}/events.parquet')")
    got = [tuple(r) for r in QUERIES[name](spark, SF).select("event_id", "k", "level", "middling").collect()]
    assert sorted(got, key=str) == sorted(con.execute(ORACLE_SQL[name]).fetchall(), key=str)
    assert len(got) == con.execute("SELECT count(*) FROM events WHERE event_type LIKE '%i%'").fetchone()[0]


def test_entry_module():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60


# --- joins on hot keys -----------------------------------------------------------------------------------
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_joins_are_joins(spark, how):
    rows = [(None if i % 9 == 0 else 7 if i % 2 else i, i) for i in range(3000)] + [(7, 5)] * 40
    many = spark.createDataFrame(rows, "k long, id long")
    few = spark.createDataFrame([(7, "hot"), (7, "twice"), (8, "x"), (None, "null")], "k long, v string")
    plain = sorted(map(str, many.join(few, "k", how).collect()))
    assert sorted(map(str, skew.spread_join(many, few, ["k"], ["id"], how).select("k", "id", "v").collect())) == plain
    assert sorted(map(str, skew.spread_join(many, few, ["k"], ["id"], how, counted=many).select("k", "id", "v").collect())) == plain
    assert skew.spread_join(many.where("false"), few, ["k"], ["id"], how).collect() == []
    # the hot key's rows are dealt over more than one task
    plain_joins = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain_joins}
    try:
        for k, v in plain_joins.items():
            spark.conf.set(k, v)
        dealt = skew.spread_join(many, few, ["k"], ["id"]).where("k = 7 AND v = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(dealt) > 1


def test_a_hub_is_dealt_over_tasks(spark, monkeypatch):
    from kinweave.operators import components

    monkeypatch.setattr(components, "FINISH", 0)
    edges = spark.createDataFrame([(0, i) for i in range(1, 3000)] + [(i, 9000) for i in range(5000, 8000)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert set(got.values()) == {0, 5000} and len(got) == 3000 + 3001


def test_clusters_must_name_a_shared_folder():
    from kinweave import runtime

    class Conf(dict):
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(Session())


# --- refusals --------------------------------------------------------------------------------------------
def test_date_pairs_are_counted_like_listed_ones(spark):
    rng = random.Random(3)
    days = [dt.date(rng.choice((1980, 1981)), rng.randint(1, 12), rng.randint(1, 28)) for _ in range(60)] + [dt.date(1980, 3, 4), dt.date(1980, 4, 3)]
    base = spark.createDataFrame([(str(i), "n", "g", "f", d if i % 7 else None, f"m{i % 2}", None) for i, d in enumerate(days)], "record_key string, name_n string, given_key string, family_name_n string, dob_usable date, email_n string, phone_n string")
    expect = {}
    for m in ("m0", "m1"):
        own = sorted({r.dob_usable for r in base.where(F.col("email_n") == m).collect() if r.dob_usable})
        expect[m] = sum(not (a.year == b.year and a.month == b.day and a.day == b.month) for i, a in enumerate(own) for b in own[i + 1 :])
    assert {r.value: r.incompatible_dob_pairs for r in profile.prevalence(base).collect()} == expect


def test_emails_are_unique(spark):
    people = spark.createDataFrame([(1, "ann"), (2, "ann"), (3, "ann2"), (4, "ann"), (5, "ann")] + [(i, "bob") for i in range(10, 400)], "k long, l string").withColumn("dm", F.lit("x"))
    got = generate.unique_emails(people, "k", "l", "dm").collect()
    assert len({r.email for r in got}) == len(got) and {r.k: r.email for r in got}[1] == "ann@x" and {r.k: r.email for r in got}[3] == "ann2@x" and [r.bumped for r in got if r.k in (1, 3)] == [False, False]


def test_survivorship_rules_are_refused(spark):
    rules = lambda *rows: spark.createDataFrame(list(rows), "field string, ordering string")
    with pytest.raises(ValueError, match="several"):
        golden.survivorship_rules(rules(("full_name", "recent"), ("full_name", "recent")), spark)
    with pytest.raises(ValueError, match="neither"):
        golden.survivorship_rules(rules(("full_name", "oldest")), spark)
    told = {r.field: r.ordering for r in golden.survivorship_rules(rules(("full_name", "recent")), spark).collect()}
    assert told["full_name"] == "recent" and told["given_name"] == "priority" and set(told) == set(golden.FIELDS)


def test_survivors_by_priority_and_by_time(spark):
    when = dt.datetime
    rows = [("c", "a", "pos", when(2024, 1, 1), 40, f, "old") for f in ("full_name", "work_email")] + [("c", "b", "sevenrooms", when(2020, 1, 1), 10, f, "first") for f in ("full_name", "work_email")] + [("c", "d", "pos", None, 5, "work_email", "never")]
    frame = spark.createDataFrame(rows, "customer_id string, record_key string, source_system string, source_updated_at timestamp, source_priority int, field string, value string")
    assert {r.field: r.value for r in golden.survivors(frame, golden.survivorship_rules(None, spark)).collect()} == {"full_name": "first", "work_email": "old"}


def test_events_with_problems_are_refused(spark):
    schema = "event_id string, source_run_id string, case_id string, applied_case_version long, action string, content_digest string, memberships array<struct<record_key:string,customer_id:string>>"
    event = lambda e, case, v, d="x", rec="r1": (e, "run", case, v, "MERGE", d, [(rec, "c")])
    fine = [event("e1", "a", 1), event("e1", "a", 1), event("e2", "a", 2), event("e3", "b", 1, rec="r2")]
    assert {(r.record_key, r.event_id) for r in review.checked_overrides(spark.createDataFrame(fine, schema)).collect()} == {("r1", "e2"), ("r2", "e3")}
    for more, problem in ((event("e1", "a", 1, "y"), "other content"), (event("e9", "a", 2), "case version"), (event("e9", "c", 1), "several cases")):
        with pytest.raises(ValueError, match=problem):
            review.checked_overrides(spark.createDataFrame([*fine, more], schema))
    other = [("e9", "run2", "a", 9, "MERGE", "x", [("r1", "z")])]  # another release's case of the same name
    assert review.checked_overrides(spark.createDataFrame(fine + other, schema)).count() == 3


def test_exported_events_must_be_sound(spark):
    schema = "event_id string, case_id string, source_run_id string, base_case_version int, applied_case_version int, actor string, mode string, proposal struct<proposal_id:string,case_id:string,case_version:int,action:string,groups:array<array<string>>>"
    make = lambda action, groups, case="c", base=1, applied=2: ("e", "c", "run", base, applied, "me", "manual", ("p", case, base, action, groups))
    good = publication.export_events(spark.createDataFrame([make("MERGE", [["b", "a"]])], schema)).first()
    again = publication.export_events(spark.createDataFrame([make("MERGE", [["a", "b"]])], schema)).first()
    import hashlib

    assert good.memberships == again.memberships and good.content_digest == again.content_digest
    assert good.memberships[0].customer_id == "steward-" + hashlib.sha256(b'["run",["a","b"]]').hexdigest()
    for bad, problem in ((make("FLIP", [["a"]]), "no such action"), (make("MERGE", [["a"]], case="d"), "another case"), (make("MERGE", [["a"]], applied=3), "versions"), (make("MERGE", [["a"], []]), "empty group"), (make("MERGE", [["a", "a"]]), "twice"),
                         (make("MERGE", [["a"], ["b"]]), "one group"), (make("SEPARATE", [["a", "b"]]), "single records"), (make("PARTITION", [["a"], ["b"]]), "several groups")):
        with pytest.raises(Exception, match=problem):
            publication.export_events(spark.createDataFrame([bad], schema)).collect()


def test_reviewed_links_must_add_up(spark):
    links = spark.createDataFrame([("a", "x", None, None), ("b", None, "k", "DEFERRED_OVERSIZED")], "record_key string, steward_decision_id string, deferred_case_key string, review_scope string")
    publication.prove(links, 2, 1, 1, 1)
    with pytest.raises(ValueError):
        publication.prove(links, 3, 1, 1, 1)
    wrong = spark.createDataFrame([("a", "x", "k", "DEFERRED_OVERSIZED")], links.schema)  # deferred and yet resolved
    with pytest.raises(ValueError):
        publication.prove(wrong, 1, 1, 1, 1)


def test_golden_fields_must_come_from_their_records(spark):
    over = spark.createDataFrame([("run", "r1", "g", "case", "e1", 2)], "source_run_id string, record_key string, customer_id string, case_id string, event_id string, applied_case_version int")
    sources = spark.createDataFrame([("r1", "pos", "1", "Ann"), ("r2", "pos", "2", "Bob")], "record_key string, source_system string, source_record_id string, name string")
    choice = lambda value="Ann", rec="r1", guest="g": spark.createDataFrame([("run", guest, "case", "name", value, rec, "e1")], "source_run_id string, guest_identity string, case_id string, field_name string, field_value string, chosen_record_key string, decision_id string")
    assert publication.reviewed_fields(choice(), over, sources).first().source_record_id == "1"
    for bad, problem in ((choice("Eve"), "not its source"), (choice("Bob", "r2"), "not its guest"), (choice(guest="h"), "not its guest")):
        with pytest.raises(Exception, match=problem):
            publication.reviewed_fields(bad, over, sources).collect()


def test_releases_are_frozen_whole(spark, tmp_path):
    store = tables.Versions(spark, f"file://{tmp_path}")
    own = {t: spark.createDataFrame([(t, 1)], "a string, b int") for t in release.FROZEN}
    names = release.freeze_release(store, own, "run-1")
    assert names["candidate_pairs"] == "frozen_candidate_pairs_run_1" and release.freeze_release(store, own, "run-1") == names
    with pytest.raises(ValueError):
        release.freeze_release(store, own | {"customer_mapping": own["customer_mapping"].withColumn("b", F.lit(2))}, "run-1")
    with pytest.raises(ValueError, match="other tables"):
        release.freeze_release(store, {k: v for k, v in own.items() if k != "pair_features"}, "run-2")
    decisions = spark.createDataFrame([("v1",), ("v2",)], "resolver_version string")
    with pytest.raises(ValueError):
        release.resolver_of(decisions)
    cases = spark.createDataFrame([("a", "a", 3, 2, False)], "component string, case_component string, records long, pairs long, deferred boolean")
    with pytest.raises(ValueError, match="sources"):
        release.manifest({"sources": ("s", 0, decisions), "mappings": ("m", 0, decisions.limit(1))}, cases, "run", "v1")


def test_versions_survive_a_write_that_broke_off(spark, tmp_path):
    v = tables.Versions(spark, f"file://{tmp_path}")
    n = spark.read.parquet(f"{SF}/nation.parquet")
    with pytest.raises(Exception, match="broke"):
        v.write("n", n.withColumn("x", F.raise_error(F.lit("broke"))))
    assert not v.exists("n") and v.write("n", n) == 0 and v.read("n").count() == 25
    assert v.rewrite("n", lambda t: tables.delete_where(t, F.col("n_nationkey") > 4)) == 1 and v.read("n").count() == 5 and v.read("n", 0).count() == 25
    with pytest.raises(ValueError):
        v.publish("m", n, 24)
    assert not v.exists("m")


def test_merges_take_null_keys_as_equal(spark):
    target = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    source = spark.createDataFrame([(None, "c"), (1, "b"), (2, "z"), (2, "d")], "k long, v string")
    assert {(r.k, r.v, r.change) for r in tables.sync(target, source.where("v <> 'z'"), ["k"], ["v"]).collect()} == {(None, "c", "UPDATE"), (1, "b", "SAME"), (2, "d", "INSERT")}
    assert {(r.k, r.v) for r in tables.insert_only(target, source, ["k"]).collect()} == {(None, "a"), (1, "b"), (2, "d")}


def test_components_that_no_task_can_hold_are_refused(spark):
    records = spark.createDataFrame([(x, None) for x in "abcd"], "record_key string, dob_usable date")
    edges = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.8), ("c", "d", 0.7)], "left_record_key string, right_record_key string, score double")
    none = edges.where("false").select("left_record_key", "right_record_key")
    assert graph.constrained_components(records, edges, none)[0].count() == 4
    for bound in ({"max_records": 3}, {"max_edges": 2}):
        with pytest.raises(ValueError, match="beyond"):
            graph.constrained_components(records, edges, none, **bound)


def test_withheld_links_must_have_a_place(spark):
    links = spark.createDataFrame([("a", "b", "COMPONENT_SIZE_LIMIT", 0.9), ("x", "y", "COMPONENT_SIZE_LIMIT", 0.8)], "left_record_key string, right_record_key string, reason string, match_probability double")
    members = spark.createDataFrame([("a", "c1"), ("b", "c2")], "record_key string, case_id string")
    with pytest.raises(ValueError, match="1 withheld"):
        steward.graph_links(links, members, members.where("false").select("record_key"))
    late = spark.createDataFrame([("y",)], "record_key string")
    assert {(r.case_id, r.other_case_id) for r in steward.graph_links(links, members, late).collect()} == {("c1", "c2"), ("c2", "c1")}


def test_cases_are_not_formed_from_a_wrong_mapping(spark):
    schema = "resolution_run_id string, record_key string, customer_id string, provisional_customer_id string, cluster_requires_review boolean"
    pairs = spark.createDataFrame([("a", "b", "REVIEW")], "left_record_key string, right_record_key string, decision string")
    good = [("run", "a", "c1", "p1", True), ("run", "b", "c2", None, False)]
    cases, members = steward.form_cases("run", spark.createDataFrame(good, schema), pairs)
    assert (cases.count(), members.count()) == (1, 2)
    for bad in ([*good, ("other", "d", "c", "p", False)], [*good, good[0]], [("run", "a", "", "p", False)], [("run", "a", "c", None, True)], [("run", "a", "c", "p", None)]):
        with pytest.raises(ValueError, match="mapping"):
            steward.form_cases("run", spark.createDataFrame(bad, schema), pairs)


def test_archives_and_resets_are_proved(spark):
    live = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k long, v string")
    steward.prove_copy(live, live.orderBy(F.desc("k")), ["k"])
    for other in (live.where("k > 0"), live.withColumn("v", F.when(F.col("k") == 3, "x").otherwise(F.col("v")))):
        with pytest.raises(ValueError):
            steward.prove_copy(live, other, ["k"])
    digest = steward.content_digest(live, ["k"]).first().digest
    assert steward.reset_states(live, live, digest, ["k"])[1].isEmpty()
    with pytest.raises(ValueError):
        steward.reset_states(live.where("k > 0"), live, digest, ["k"])


def test_sources_with_answers_are_refused(spark):
    from kinweave.sources.guests import SCHEMA, snapshot

    guests = spark.createDataFrame([], SCHEMA)
    assert snapshot(guests).columns[-2:] == ["record_key", "source_hash"]
    with pytest.raises(ValueError, match="answers"):
        snapshot(guests.withColumn("truth_person_id", F.lit(1)))
    with pytest.raises(ValueError, match="missing"):
        snapshot(guests.drop("company_name"))
    with pytest.raises(ValueError, match="may not"):
        steward.adapt_records(guests.withColumn("scenario_id", F.lit(1)))


def test_exports_and_pages_are_checked(spark, tmp_path):
    n = spark.read.parquet(f"{SF}/nation.parquet")
    assert sum(r.rows for r in tables.export_ordered(n, ["n_nationkey"], f"file://{tmp_path}/a", 25, 10).collect()) == 25
    for keys, rows in ((["n_nationkey"], 24), (["n_regionkey"], 25)):
        with pytest.raises(ValueError):
            tables.export_ordered(n, keys, f"file://{tmp_path}/b{rows}{keys[0]}", rows)
    with pytest.raises(ValueError):
        list(tables.pages(n.withColumn("n_nationkey", F.when(F.col("n_nationkey") > 3, F.col("n_nationkey"))), ["n_nationkey"], 10, 25))


def test_cell_index(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) + 6 * (i % 5 == j) for j in range(5)]) for i in range(400)]
    unit = [(i, [x / sum(y * y for y in v) ** 0.5 for x in v]) for i, v in rows] + [(None, [1.0] * 5), (999, None)]
    frame = spark.createDataFrame(unit, "vec_id long, embedding array<float>")
    index, exact = vectors.CellIndex(frame, 10), vectors.knn(frame, frame, 5)
    assert vectors.recall(index.search(frame, 5, 10), exact) == 1.0 and vectors.recall(index.search(frame, 5, 4, block=16), exact) > 0.9
    assert index.agrees(frame) and not index.agrees(frame.where("vec_id > 0"))
    empty = vectors.CellIndex(frame.where("false"))
    assert empty.search(frame, 5, 1).collect() == [] and index.search(frame.where("false"), 5, 2).collect() == []


def test_names_in_other_writing():
    assert len(population.INITIALS) * len(population.VOWELS) * len(population.FINALS) == 11172


def test_all_named_functions_have_a_query_or_a_test():
    """Each engine query has SQL, but those that a learned model or a random sample decides."""
    import __spark_entry__ as e

    without = {n for n in e.queries() if n not in e.oracle_sql() and not n.startswith("op") and n != "pipeline"}
    assert without <= {"learned_model", "name_variants", "constrained_components", "persistent_ids", "steward_cases"}


def test_pairs_meet_once_without_a_shuffle_of_pairs(spark):
    """Oversized blocks that are parted, keys with the parting mark, nulls and equal record keys: the same pairs as from listed blocks."""
    rng = random.Random(4)
    some = lambda *v: rng.choice(v)
    rows = [(f"k{i:04d}", some("pos", "payments"), some("A b", "Bc", "Cd", None), some("X", "Y", "Z#1", None), some("e1", "e1#X", f"m{i // 3}", None), some(f"61{i // 2}", None), some("w", None), None,
             some("1 st", "2 st#Y", "2 st"), None, some("2000", None), some("1990-01-02", None)) for i in range(400)]
    made = lambda rows: materialize(spark.createDataFrame(rows, "record_key string, source_system string, given_name_n string, family_name_n string, email_n string, phone_n string, work_email_n string, "  # noqa: E731
                                                          "work_phone_n string, home_address_n string, work_address_n string, postcode_n string, dob_usable string"), "given")
    told = lambda df: sorted(tuple(map(str, r)) for r in df.select("left_record_key", "right_record_key", "candidate_reasons", "candidate_routes", "candidate_scopes").collect())
    for base in (made(rows), made(rows + [("k0001", "pos", *rows[7][2:]), rows[9]])):
        assert told(blocking.met_pairs(base, max_block=20)) == told(blocking.candidate_pairs(blocking.candidate_hits(blocking.blocking_keys(base, 20), 20)))
        found = blocking.met_pairs(base, ["email_n"], max_block=20).join(base.select(F.col("record_key").alias("left_record_key"), F.col("email_n").alias("e")), "left_record_key")
        assert base.count() > 400 or found.where("NOT e <=> email_n_l").isEmpty()


def test_candidate_queries_shuffle_records_only(spark):
    for name in ("candidate_hits", "candidate_pairs_union", "pair_features"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        dealt = [line for line in plan.splitlines() if "Exchange" in line]
        assert dealt and not any("record_key" in line.split("[plan_id")[0] for line in dealt), (name, dealt)


def test_a_task_of_neighbours_scores_few_queries_at_once():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = vectors.QUERIES * 2 + 7
    x = np.round(rng.normal(size=(n, 4)), 1)
    rows = pa.record_batch([pa.array([list(range(n))] * 2), pa.array([x.tobytes()] * 2), pa.array([list(range(n))[::-1]] * 2), pa.array([x[::-1].tobytes()] * 2)], ["q_ids", "q_matrix", "ids", "matrix"])
    parts = list(vectors._best(3, 6)(iter([rows])))
    assert max(p.num_rows for p in parts) <= vectors.QUERIES * 3
    found = pa.Table.from_batches(parts).to_pylist()
    assert len(found) == 2 * 3 * n
    score = np.round(x @ x.T, 6)
    for q in (0, vectors.QUERIES, n - 1):
        want = sorted((-score[q, j], j) for j in range(n) if j != q)[:3]
        assert [(-r["score"], r["neighbour_id"]) for r in found if r["query_id"] == q][:3] == want


def test_stage_tables_hold_what_is_read(spark, monkeypatch):
    from kinweave.plans import resolution

    kept = {}
    monkeypatch.setattr(resolution, "materialize", lambda df, label: kept.setdefault(label, df) and materialize(df, label))
    for name, columns in (("golden_profile", resolution.GOLDEN), ("er_flagship_decisions", resolution.RESOLVED)):
        kept.clear()
        QUERIES[name](spark, "/root/testdata/sf0.001")
        assert set(kept["base"].columns) == set(columns) and dict(kept["base"].dtypes)["record_key"] == "binary"
