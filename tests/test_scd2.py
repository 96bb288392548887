from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapidar.operators import scd2
from lapidar.operators.checks import dimension_scd2, require_passed
from lapidar.operators.scd2 import (
    CHANGE,
    active_only,
    change_counts,
    close_versions,
    detect_changes,
    insert_missing,
    insert_versions,
    scd2_apply,
    scd2_incremental,
    union_changes,
    version_history,
)
from lapidar.plans.jobs import load_dimension

T = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"]
ORIGIN = datetime(1900, 1, 1)
FULL = "id_cliente bigint, nome_cliente string, cidade string, estado string"
SHORT = "id_cliente bigint, nome_cliente string, cidade string"
KEY, TRACKED = "id_cliente", ["nome_cliente", "cidade"]


def at(i):
    return datetime.fromisoformat(T[i])


def clients(spark, data):
    return spark.createDataFrame(data, SHORT)


def test_detects_new_changed_unchanged(spark):
    gold = spark.createDataFrame(
        [(1, "Ana Silva", "SP", "SP"), (2, "João Costa", "RJ", "RJ"), (3, "Maria Lima", "BH", "MG")], FULL
    )
    new = spark.createDataFrame(
        [(1, "Ana Silva", "SP", "SP"), (2, "João Costa", "Niterói", "RJ"), (4, "Pedro Souza", "POA", "RS")], FULL
    )
    tracked = ["nome_cliente", "cidade", "estado"]
    labelled = detect_changes(scd2_apply(None, gold, KEY, tracked, T[0]), new, KEY, tracked)
    assert rows(labelled, KEY, CHANGE) == [(1, "sem_alteracao"), (2, "alterado"), (4, "novo")]
    assert tuple(change_counts(labelled).first()) == (1, 1, 1)
    assert rows(union_changes(labelled), KEY) == [(2,), (4,)]


def test_null_changes_are_changes(spark):
    dim = scd2_apply(None, clients(spark, [(1, "a", None), (2, "b", "x"), (3, "c", None)]), KEY, TRACKED, T[0])
    new = clients(spark, [(1, "a", "x"), (2, "b", None), (3, "c", None)])
    assert rows(detect_changes(dim, new, KEY, TRACKED), KEY, CHANGE) == [
        (1, "alterado"), (2, "alterado"), (3, "sem_alteracao"),
    ]
    assert scd2_apply(dim, new, KEY, TRACKED, T[1]).count() == 5


def test_lifecycle(spark):
    dim = scd2_apply(None, clients(spark, [(1, "Ana", "SP"), (2, "Bruno", "RJ")]), KEY, TRACKED, T[0])
    assert dim.count() == 2 and active_only(dim).count() == 2
    dim = scd2_apply(dim, clients(spark, [(1, "Ana", "SP"), (2, "Bruno", "RJ"), (3, "Carlos", "MG")]), KEY, TRACKED, T[1])
    assert active_only(dim).count() == 3
    dim = scd2_apply(dim, clients(spark, [(1, "Ana Silva", "SP"), (2, "Bruno", "RJ"), (3, "Carlos", "MG")]), KEY, TRACKED, T[2])
    history = version_history(dim, KEY, 1).collect()
    assert [(r.nome_cliente, r.data_inicio_vigencia, r.data_fim_vigencia, r.registro_ativo) for r in history] == [
        ("Ana", ORIGIN, at(2), False),
        ("Ana Silva", at(2), None, True),
    ]
    require_passed(dimension_scd2(dim, "dim", KEY))


def test_first_version_of_late_keys(spark):
    dim = scd2_apply(None, clients(spark, [(1, "a", "x")]), KEY, TRACKED, T[0])
    later = clients(spark, [(1, "a", "x"), (2, "b", "y")])
    default = scd2_apply(dim, later, KEY, TRACKED, T[1])
    strict = scd2_apply(dim, later, KEY, TRACKED, T[1], None)
    assert version_history(default, KEY, 2).first().data_inicio_vigencia == ORIGIN
    assert version_history(strict, KEY, 2).first().data_inicio_vigencia == at(1)


def test_tracked_columns_are_required(spark):
    with pytest.raises(ValueError, match="tracked column"):
        scd2_apply(None, clients(spark, [(1, "a", "x")]), KEY, [], T[0])


def test_step_by_step_equals_apply(spark):
    dim = scd2_apply(None, clients(spark, [(1, "a", "x"), (2, "b", "y")]), KEY, TRACKED, T[0])
    new = clients(spark, [(1, "a", "z"), (3, "c", "w")])
    labelled = detect_changes(dim, new, KEY, TRACKED)
    changed = labelled.filter("mudanca = 'alterado'")
    closed = close_versions(dim, changed, KEY, T[1])
    by_hand = insert_missing(closed, new, KEY, T[1])
    assert rows(by_hand) == rows(scd2_apply(dim, new, KEY, TRACKED, T[1], None).select(*by_hand.columns))
    assert rows(scd2_incremental(dim, new, KEY, TRACKED, T[1])) == rows(scd2_apply(dim, new, KEY, TRACKED, T[1]))


def test_insert_versions_adds_whatever_is_there(spark):
    new = clients(spark, [(1, "Ana", "Campinas")])
    dim = insert_versions(None, clients(spark, [(1, "Ana", "SP")]), T[0])
    both = insert_versions(close_versions(dim, new, KEY, T[1]), new, T[1])
    assert [r.cidade for r in version_history(both, KEY, 1).collect()] == ["SP", "Campinas"]
    assert rows(active_only(both), "cidade") == [("Campinas",)]
    assert both.filter("not registro_ativo and data_fim_vigencia is null").count() == 0


snapshots = st.lists(
    st.dictionaries(st.integers(1, 4), st.sampled_from(["a", "b", None]), max_size=4), min_size=1, max_size=4
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshots)
def test_validity_has_no_gap_and_no_overlap(spark, states):
    dim, expected = None, {}
    for i, state in enumerate(states):
        batch = (datetime(2024, 1, 1) + timedelta(days=i)).isoformat(sep=" ")
        snapshot = clients(spark, [(k, "n", v) for k, v in state.items()])
        dim = scd2_apply(dim, snapshot, KEY, TRACKED, batch)
        again = scd2_apply(dim, snapshot, KEY, TRACKED, batch)
        assert rows(again) == rows(dim)
        expected.update(state)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    versions = {}
    for r in dim.collect():
        versions.setdefault(r.id_cliente, []).append(r)
    assert {k: [v.cidade for v in vs if v.registro_ativo] for k, vs in versions.items()} == {
        k: [v] for k, v in expected.items()
    }
    for vs in versions.values():
        vs.sort(key=lambda r: r.data_inicio_vigencia)
        assert vs[0].data_inicio_vigencia == ORIGIN and vs[-1].data_fim_vigencia is None
        for a, b in zip(vs, vs[1:]):
            assert a.data_fim_vigencia == b.data_inicio_vigencia and not a.registro_ativo


def silver_clients(lake, data):
    spark = lake.spark
    lake.publish(
        spark.createDataFrame([(k, n, "1", "e") for k, n, *_ in data],
                              "id_cliente int, nome_completo string, cpf string, email string"),
        "silver", "clientes")
    lake.publish(
        spark.createDataFrame([(k, k, c, s) for k, _, c, s in data],
                              "id_endereco int, id_cliente int, cidade string, estado string"),
        "silver", "enderecos")


def test_incremental_dimension_load(lake):
    first = [(1, "Ana Silva", "SP", "SP"), (2, "João Costa", "RJ", "RJ")]
    silver_clients(lake, first)
    assert load_dimension(lake, "dim_clientes", T[0])["novos"] == 2
    files = lake.read("gold", "dim_clientes").inputFiles()
    assert load_dimension(lake, "dim_clientes", T[1]) == {"novos": 0, "alterados": 0, "sem_alteracao": 2}
    assert lake.read("gold", "dim_clientes").inputFiles() == files
    silver_clients(lake, [(1, "Ana Silva", "Campinas", "SP"), (2, "João Costa", "RJ", "RJ"), (3, "Maria Lima", "BH", "MG")])
    assert load_dimension(lake, "dim_clientes", T[2]) == {"novos": 1, "alterados": 1, "sem_alteracao": 1}
    dim = lake.read("gold", "dim_clientes")
    require_passed(dimension_scd2(dim, "dim_clientes", "id_cliente"))
    assert dim.count() == 4
    assert rows(active_only(dim), "id_cliente", "cidade") == [(1, "Campinas"), (2, "RJ"), (3, "BH")]
    assert lake.read("gold", "dim_clientes", ["ativo"]).count() == 3
    assert scd2.ACTIVE in dim.columns


def test_client_with_two_addresses_or_none(lake):
    spark = lake.spark
    silver_clients(lake, [(1, "Ana", "SP", "SP")])
    lake.publish(spark.createDataFrame([(1, "Ana", "1", "e"), (2, "Bia", "2", "e")],
                 "id_cliente int, nome_completo string, cpf string, email string"), "silver", "clientes")
    lake.publish(spark.createDataFrame([(10, 1, "RJ", "RJ"), (11, 1, "BH", "MG"), (12, None, "X", "Y")],
                 "id_endereco int, id_cliente int, cidade string, estado string"), "silver", "enderecos")
    load_dimension(lake, "dim_clientes", T[0])
    assert rows(lake.read("gold", "dim_clientes"), "id_cliente", "cidade") == [(1, "BH"), (2, None)]
