from workdays.operators.load import insertar_ignorando, primero_por_clave

SCHEMA = "k1 int, k2 string, v string, w int"


def test_first_wins_deterministic(spark):
    batch = spark.createDataFrame([(1, "a", "z", 1), (1, "a", "b", 2), (1, "a", "b", 1), (2, "a", "x", 0)], SCHEMA)
    out = {(r.k1, r.k2): (r.v, r.w) for r in primero_por_clave(batch, ["k1", "k2"]).collect()}
    assert out == {(1, "a"): ("b", 1), (2, "a"): ("x", 0)}
    by_w = {(r.k1, r.k2): (r.v, r.w) for r in primero_por_clave(batch, ["k1", "k2"], ["w"]).collect()}
    assert by_w[(1, "a")] == ("b", 1)  # w=1 twice, tie broken by v


def test_null_keys_never_conflict(spark):
    batch = spark.createDataFrame([(None, "a", "p", 1), (None, "a", "q", 2), (1, None, "r", 3)], SCHEMA)
    target = spark.createDataFrame([(None, "a", "old", 0)], SCHEMA)
    assert insertar_ignorando(target, batch, ["k1", "k2"]).count() == 3


def test_skips_existing_keys(spark):
    target = spark.createDataFrame([(1, "a", "old", 0)], SCHEMA)
    batch = spark.createDataFrame([(1, "a", "new", 1), (2, "a", "n2", 1), (2, "a", "n1", 1)], SCHEMA)
    out = insertar_ignorando(target, batch, ["k1", "k2"]).collect()
    assert [(r.k1, r.v) for r in out] == [(2, "n1")]


def test_twice_equals_once(spark):
    target = spark.createDataFrame([(1, "a", "old", 0)], SCHEMA)
    batch = spark.createDataFrame([(1, "a", "new", 1), (2, "a", "n2", 1), (3, "b", "n3", 1)], SCHEMA)
    once = insertar_ignorando(target, batch, ["k1", "k2"])
    after = target.unionByName(once)
    again = insertar_ignorando(after, batch, ["k1", "k2"])
    assert once.count() == 2 and again.count() == 0


def test_bounded_target_side_same_result(spark):
    target = spark.createDataFrame([(1, "a", "old", 0), (5, "a", "x", 9)], SCHEMA)
    batch = spark.createDataFrame([(1, "a", "new", 1), (2, "a", "n2", 1)], SCHEMA)
    a = sorted(map(tuple, insertar_ignorando(target, batch, ["k1", "k2"]).collect()))
    b = sorted(map(tuple, insertar_ignorando(target, batch, ["k1", "k2"], acotar_por="k1").collect()))
    assert a == b == [(2, "a", "n2", 1)]
