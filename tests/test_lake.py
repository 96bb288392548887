from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapidar.operators.checks import IntegrityError, dimension_scd2, require_passed, single_active
from lapidar.operators.scd2 import open_versions
from lapidar.operators.control import EPOCH, get_checkpoint, save_checkpoint
from lapidar.plans.jobs import persist_and_validate
from lapidar.session import scratch_dir
from lapidar.sources.landing import (
    assert_not_empty,
    landing_path,
    read_landing,
    read_raw_csv,
    write_landing,
)
from lapidar.sources.schemas import raw_schema


def frame(spark, data):
    return spark.createDataFrame(data, "p string, v int")


def publish(lake, data, replaced):
    lake.publish_parts(frame(lake.spark, data), "gold", "t", F.col("p"), replaced)


def test_versions_replace_and_open_readers_keep_theirs(lake):
    assert not lake.exists("silver", "t")
    lake.publish(frame(lake.spark, [("a", 1)]), "silver", "t")
    first = lake.read("silver", "t")
    lake.publish(frame(lake.spark, [("a", 2)]), "silver", "t")
    assert rows(first, "v") == [(1,)] and rows(lake.read("silver", "t"), "v") == [(2,)]


def test_parts_are_replaced_added_and_emptied(lake):
    publish(lake, [("a", 1), ("b", 1)], [])
    publish(lake, [("b", 2), ("c", 2)], ["b"])
    assert rows(lake.read("gold", "t"), "v") == [(1,), (2,), (2,)]
    assert lake.parts("gold", "t") == ["a", "b", "c"]
    publish(lake, [("c", 3)], ["a", "c"])
    assert lake.parts("gold", "t") == ["b", "c"]
    assert rows(lake.read("gold", "t", ["c"]), "v") == [(3,)]


def test_unfinished_write_is_invisible_and_can_be_repeated(lake, tmp_path):
    publish(lake, [("a", 1)], [])
    folder = tmp_path / "lake" / "gold" / "t" / "_v=2"
    (folder / "_part=a").mkdir(parents=True)
    (folder / "_replaced=a").mkdir()
    assert rows(lake.read("gold", "t"), "v") == [(1,)]
    publish(lake, [("a", 5)], ["a"])
    assert rows(lake.read("gold", "t"), "v") == [(5,)]


def test_empty_table_cannot_be_read_but_exists(lake):
    publish(lake, [("a", 1)], [])
    publish(lake, [], ["a"])
    assert lake.exists("gold", "t")
    with pytest.raises(FileNotFoundError):
        lake.read("gold", "t")


def test_compaction_keeps_rows_and_parts(lake):
    spark = lake.spark
    many = spark.range(100).select(F.when(F.col("id") < 50, "a").otherwise("b").alias("p"), F.col("id").cast("int").alias("v"))
    lake.publish(many.repartition(8), "gold", "whole")
    assert lake.file_count("gold", "whole") == 8
    lake.compact("gold", "whole")
    assert lake.file_count("gold", "whole") == 1 and lake.read("gold", "whole").count() == 100
    publish(lake, [("a", 1), ("b", 1)], [])
    publish(lake, [("b", 2)], ["b"])
    lake.compact("gold", "t")
    assert lake.parts("gold", "t") == ["a", "b"]
    assert rows(lake.read("gold", "t"), "v") == [(1,), (2,)]


def test_append_accumulates(lake):
    for v in (1, 2):
        lake.append(frame(lake.spark, [("a", v)]), "bronze", "t")
    assert lake.exists("bronze", "t") and rows(lake.read("bronze", "t"), "v") == [(1,), (2,)]


def test_checkpoint_falls_back_only_when_absent(lake):
    assert get_checkpoint(lake, "job", ["a", "b"]) == {"a": EPOCH, "b": EPOCH}
    save_checkpoint(lake, "job", {"a": "2024-01-01 00:00:00"})
    assert get_checkpoint(lake, "job", ["a", "b"]) == {"a": "2024-01-01 00:00:00", "b": EPOCH}
    lake.publish(frame(lake.spark, [("x", 1)]), "control", "broken")
    with pytest.raises(Exception):
        get_checkpoint(lake, "broken", ["a"])


def test_landing_round_trip_keeps_text(spark, tmp_path):
    data = [("1", 'say "hi", you', " x ", None)]
    df = spark.createDataFrame(data, "id_endereco string, id_cliente string, estado string, cidade string")
    write_landing(df, str(tmp_path), "enderecos")
    write_landing(df, str(tmp_path), "enderecos")
    assert rows(read_landing(spark, str(tmp_path), "enderecos")) == data


def test_wrong_header_is_refused(spark, tmp_path):
    folder = tmp_path / "lojas" / "lojas_raw.csv"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id_loja,estado_loja,nome_loja\n1,SP,Centro\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, str(tmp_path), "lojas").collect()


def test_empty_field_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_categoria,nome_categoria\n1,\n")
    assert rows(read_raw_csv(spark, str(tmp_path / "a.csv"), raw_schema("categorias"))) == [("1", None)]
    assert landing_path("/x/", "lojas") == "/x/lojas/lojas_raw.csv"


def test_empty_table_is_refused(spark):
    with pytest.raises(ValueError, match="'t' is empty"):
        assert_not_empty(frame(spark, []), "t")


def test_scratch_follows_the_session_setting(spark):
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")

    def session(master, setting):
        context = SimpleNamespace(
            master=master,
            getConf=lambda: {"spark.checkpoint.dir": setting} if setting else {},
            getCheckpointDir=lambda: None,
        )
        return SimpleNamespace(sparkContext=context)

    assert scratch_dir(session("yarn", "/shared/ckpt/"), "a").startswith("/shared/ckpt/a-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn", None), "a")


def test_persist_and_validate(lake):
    dim = open_versions(
        lake.spark.createDataFrame([(1, "Ana", "SP"), (2, "Bruno", "RJ")], "id_cliente bigint, nome_cliente string, cidade string"),
        "2024-01-01", "2024-01-01",
    )
    lake.publish(dim, "gold", "dim_clientes")
    assert persist_and_validate(lake, "dim_clientes")
    assert lake.read("gold", "dim_clientes").count() == 2
    lake.publish(dim.union(dim.filter("id_cliente = 1")), "gold", "dim_clientes")
    assert not persist_and_validate(lake, "dim_clientes")
    assert not persist_and_validate(lake, "dim_lojas")
    missing = dimension_scd2(None, "dim_lojas", "id_loja")
    assert rows(missing) == [("dim_lojas", "tabela_existe", 0, False)]
    with pytest.raises(IntegrityError, match="tabela_existe"):
        require_passed(missing)
    assert single_active(None, "id_loja").first().passou
