import pytest
from pyspark.sql import functions as F

from tests.fixtures import D, calls, dims, llamada
from workdays.operators import filters
from workdays.operators.setops import union_distinta, unir_por_nombre


def test_exclusion_drops_null_names(spark):
    c = calls(spark, [llamada(D(2022, 11, 1), n, 17) for n in ("tom", "yud", "ana", None)])
    assert [r["log_name"] for r in filters.excluir_agentes(c, ["tom", "yud"]).collect()] == ["ana"]


def test_membership(spark):
    c = calls(spark, [llamada(D(2022, 11, 1), n, 17) for n in ("a", "b", "c")])
    assert filters.es_miembro(c, []).count() == 0
    assert filters.es_miembro(c, ["a", "c"]).count() == 2
    chosen = spark.createDataFrame([("b",), ("b",)], "log_name string")
    assert filters.es_miembro(c, chosen).count() == 1


def test_active_and_lookup(spark):
    agentes, _, programas = dims(spark)
    assert filters.activos(agentes).count() == 5
    p = filters.programa_por_id(programas, 17)
    assert p == {"id": 17, "nombre_monitor": "ANILLOS", "nombre_salida": "", "directorio": ""}
    with pytest.raises(KeyError):
        filters.programa_por_id(programas, 99)


def test_union_distinct_and_by_name(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "g int, d string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "g int, d string")
    assert union_distinta(a, b).count() == 2
    c = spark.createDataFrame([(3, "z", 9)], "g int, d string, CC int")
    e = spark.createDataFrame([(4,)], "g int")
    u = unir_por_nombre([c, e], drop=["CC"])
    assert u.columns == ["g", "d"] and u.where(F.col("d").isNull()).count() == 1
    assert unir_por_nombre([e, e], drop=["CC"]).count() == 2  # dropping an absent column is a no-op
