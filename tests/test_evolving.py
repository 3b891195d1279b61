import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_ingest import SCHEMA, deliver
from tideline.schemas import LINEAGE
from tideline.sources.files import VERSION
from tideline.streaming.evolving import RESCUED, current_schema, read_evolving, stream_evolving


def run(spark, tmp_path, **options):
    args = str(tmp_path / "landing"), SCHEMA, str(tmp_path / "table"), str(tmp_path / "check")
    stream_evolving(spark, *args, **options).awaitTermination()
    return read_evolving(spark, args[2], args[3], SCHEMA)


def test_columns_of_later_files_are_added(spark, tmp_path):
    landing = str(tmp_path / "landing")
    deliver(landing, 1, ["1,1.5,a", "2,2.5,b"])
    deliver(landing, 2, ["b2,3,3.5"], "name,K,price")
    first = run(spark, tmp_path)
    assert first.columns == ["k", "price", "name", RESCUED, LINEAGE, VERSION]
    assert sorted((r.k, r.price, r.name, r[VERSION]) for r in first.collect()) == [(1, 1.5, "a", 1), (2, 2.5, "b", 1), (3, 3.5, "b2", 2)]
    deliver(landing, 3, ["4,4.5,7,x", "5,oops,n/a,y", "6,6.5,8", '7,"7.5",9,"a,b",more'], "k,price,beds,extra")
    hints = T.StructType([T.StructField("beds", T.IntegerType())])
    grown = run(spark, tmp_path, hints=hints)
    assert grown.columns == ["k", "price", "name", "beds", "extra", RESCUED, LINEAGE, VERSION]
    assert grown.schema["beds"].dataType == T.IntegerType()
    rows = {r.k: r for r in grown.collect()}
    assert len(rows) == 7 and grown.count() == 7
    assert (rows[1].name, rows[1].beds, rows[1].extra) == ("a", None, None)
    assert (rows[4].price, rows[4].name, rows[4].beds, rows[4].extra, rows[4][RESCUED]) == (4.5, None, 7, "x", None)
    assert json.loads(rows[5][RESCUED]) == {"price": "oops", "beds": "n/a"} and rows[5].price is None
    assert rows[6].beds == 8 and list(json.loads(rows[6][RESCUED]).values()) == ["6,6.5,8"]
    assert list(json.loads(rows[7][RESCUED]).values()) == ['7,"7.5",9,"a,b",more']
    # Another run with nothing new, and one whose column is known by now.
    assert run(spark, tmp_path).count() == 7
    deliver(landing, 4, ["8,3"], "K,BEDS")
    last = run(spark, tmp_path)
    assert last.columns == grown.columns and last.filter("k = 8").first().beds == 3


def test_one_file_a_batch_and_files_without_rows(spark, tmp_path):
    landing = str(tmp_path / "landing")
    deliver(landing, 1, ["1,1.5,a"])
    deliver(landing, 2, [], "k,price,name,late")
    (tmp_path / "landing" / "listing_3.csv").write_text("")
    found = run(spark, tmp_path, max_files=1)
    assert found.count() == 1 and "late" in found.columns and found.first().late is None
    assert current_schema(spark, str(tmp_path / "check"), SCHEMA).names == ["k", "price", "name", "late"]


def test_own_columns_are_refused_and_nothing_yet_is_empty(spark, tmp_path):
    landing = str(tmp_path / "landing")
    assert read_evolving(spark, str(tmp_path / "table"), str(tmp_path / "check"), SCHEMA).filter(F.lit(True)).collect() == []
    deliver(landing, 1, ["1,1.5,x"], f"k,price,{RESCUED}")
    with pytest.raises(Exception, match="keeps for itself"):
        run(spark, tmp_path)
