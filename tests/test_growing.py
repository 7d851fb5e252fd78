"""Tables that grow with their deliveries: inferred columns, rescued fields made columns."""
import json
import os
import posixpath

import pytest
from pyspark.sql import types as T

from ledgerloom.streaming import growing as G


def write(path, name, *rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


@pytest.fixture()
def made(spark, tmp_root, request):
    table = f"grow_{abs(hash(request.node.name)) % 10**9}"
    landing = posixpath.join(tmp_root, "landing")

    def load(**kw):
        return G.load_growing(spark, "rows", landing, table, posixpath.join(tmp_root, "ck"), **kw)

    def declare(ddl):
        G.declare_growing(spark, table, T._parse_datatype_string(ddl) if ddl else T.StructType([]), location=posixpath.join(tmp_root, "t"))

    yield landing, table, declare, load
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_inferred_columns_grow_from_new_files_alone(spark, made, monkeypatch):
    landing, table, declare, load = made
    declare("")
    write(landing, "a.json", {"id": 1, "x": 1.5}, {"id": 2})
    assert load(infer=True)["rows"] == 2
    looked = []
    widen = G._widen
    monkeypatch.setattr(G, "_widen", lambda s, t, found, parts: (looked.append([f.name for f in found]), widen(s, t, found, parts)))
    write(landing, "b.json", {"id": 3, "y": True, "deep": {"a": [1, 2]}}, {"id": "odd"})
    assert load(infer=True)["rows"] == 2 and load(infer=True)["batches"] == {}
    assert looked == [["deep", "id", "y"]]              # the new file's fields, once
    kinds = dict(spark.table(table).dtypes)
    assert (kinds["id"], kinds["x"], kinds["y"], kinds["deep"]) == ("bigint", "double", "boolean", "string")
    rows = {r.id: r for r in spark.table(table).collect()}
    assert rows[1].x == 1.5 and rows[1].y is None and rows[3].y is True and rows[3].deep == '{"a":[1,2]}'
    assert json.loads(rows[None]._rescued_data) == {"id": "odd"}


def test_a_rescued_field_becomes_a_column(spark, made):
    landing, table, declare, load = made
    declare("id bigint")
    write(landing, "a.json", {"id": 1, "n": 5, "o": "x"}, {"id": 2}, {"id": 3, "n": "many"}, {"id": 4, "n": None}, "broken")
    assert load()["rows"] == 5
    found = {r.field: (r.rows, r.type) for r in G.rescued_fields(spark.table(table)).collect()}
    assert found["n"] == (3, "string") and found["o"] == (1, "string")
    assert G.promote(spark, table, "n", "bigint") == 3
    write(landing, "b.json", {"id": 6, "n": 7}, {"id": 7, "n": "none", "o": "y"})
    assert load()["rows"] == 2
    rows = {r.id: (r.n, r._rescued_data) for r in spark.table(table).collect()}
    assert rows[1] == (5, '{"o":"x"}') and rows[2] == (None, None) and rows[3] == (None, '{"n":"many"}') and rows[4] == (None, None)
    assert rows[6] == (7, None) and rows[7][0] is None and json.loads(rows[7][1]) == {"n": "none", "o": "y"}
    assert rows[None] == (None, "broken")
    assert G.promote(spark, table, "n", "bigint") == 2          # what does not fit stays rescued
    assert spark.table(table).count() == 7
    assert {r.field: r.type for r in G.rescued_fields(spark.table(table)).collect()} == {"n": "string", "o": "string"}


def test_types_of_rescued_fields(spark):
    rows = spark.createDataFrame([('{"a":"1","b":"1.5","c":"2000-01-02","d":"true","e":"x","f":null}',),
                                  ('{"a":"2","b":"2","c":"2000-02-30","d":"false"}',)], "_rescued_data string")
    assert {r.field: r.type for r in G.rescued_fields(rows).collect()} == {
        "a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "string", "f": "string"}
