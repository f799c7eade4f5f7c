from conftest import rows_of

from retailoom.functions.numbering import number_by_hash, rank_rows, surrogate_key


def test_keys_are_dense_and_one_per_id(spark):
    rows = spark.range(5000).selectExpr("concat('U', id) as user_id", "cast(id as string) as name")
    keyed = surrogate_key(rows.unionByName(rows), "user_id", "user_key").collect()
    assert len(keyed) == 5000
    assert sorted(row["user_key"] for row in keyed) == list(range(1, 5001))
    assert all(row["user_id"] == "U" + row["name"] for row in keyed)


def test_keys_do_not_depend_on_partitioning(spark):
    rows = spark.range(500).selectExpr("concat('U', id) as user_id", "id as n")
    one = rows_of(surrogate_key(rows, "user_id", "k").select("user_id", "k"))
    assert one == rows_of(surrogate_key(rows.repartition(7), "user_id", "k").select("user_id", "k"))
    assert one == rows_of(number_by_hash(rows, "user_id", "k").select("user_id", "k"))


def test_repeated_id_keeps_its_smallest_row(spark):
    rows = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z")], "id string, v string")
    assert {(r["id"], r["v"]) for r in surrogate_key(rows, "id", "k").collect()} == {("a", "x"), ("b", "z")}


def test_known_ids_keep_their_key(spark):
    before = surrogate_key(spark.range(100).selectExpr("concat('U', id) as id"), "id", "k")
    after = surrogate_key(spark.range(50, 200).selectExpr("concat('U', id) as id"), "id", "k", before)
    old, new = dict(before.collect()), {r["id"]: r["k"] for r in after.collect()}
    assert len(new) == 150
    assert all(new[i] == old[i] for i in new if i in old)
    assert sorted(k for i, k in new.items() if i not in old) == list(range(101, 201))


def test_ranks_by_ranges(spark):
    rows = [(n, n % 3, None if n % 50 == 0 else (n * 7919) % 300) for n in range(1000)]
    frame = spark.createDataFrame(rows, "k int, g int, v int")
    found = {r["k"]: (r["all_rank"], r["own_rank"]) for r in rank_rows(rank_rows(frame, "v", "all_rank", ["k"]), "v", "own_rank", ["k"], within="g").collect()}
    order = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    expected = {k: (n + 1,) for n, (k, _, _) in enumerate(order)}
    for g in range(3):
        for n, (k, _, _) in enumerate(r for r in order if r[1] == g):
            expected[k] += (n + 1,)
    assert found == expected
