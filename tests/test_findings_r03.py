"""Findings of round 3."""
import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from helpers import box, frame
from suite import base
from suite import registry_queries as RQ
from suite import text_queries as TX
from suite import theme_queries as TQ
from zonaria.operators import partition as P
from zonaria.operators import pyramid as PY
from zonaria.operators import registry as R
from zonaria.operators import schema_rules as SR
from zonaria.operators import shapes
from zonaria.operators import spatial_join as J
from zonaria.operators import tiling as T
from zonaria.functions import text as X
from zonaria.sources import sinks


def test_pixels_multiply_as_floats(spark, tmp_path):
    """Components whose product with 1000 is a whole number as FLOAT and lies just beside it as DOUBLE."""
    rows = [[-0.061000000685453415, -0.14900000393390656], [0.05299999937415123, 0.25]]
    pq.write_table(pa.table({"vec_id": pa.array([0, 1], pa.int64()), "embedding": pa.array(rows, pa.list_(pa.float32()))}), tmp_path / "embeddings.parquet")
    got = [(r["row"], r["col"], r["value"]) for r in base.relation(spark, str(tmp_path), "pixels").orderBy("row", "col").collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    want = con.execute(base.oracle("pixels", "SELECT row, col, value FROM pixels WHERE col < 2 ORDER BY row, col")).fetchall()
    assert got == want == [(0, 0, -61.0), (0, 1, -149.0), (1, 0, 53.0), (1, 1, 250.0)]


def test_decisions_on_ground_are_not_broadcast(spark, monkeypatch):
    """Decisions grow with the ground, so the join that places them is named a merge join, and its result is stored."""
    comunas = frame(spark, [("a", box(0, 0, 10, 10))], "cut string, geom GEOM")
    features = frame(spark, [(1, "PRC", 0, "a", box(1, 1, 5, 5)), (2, "PRI_U", 0, None, box(3, 3, 20, 20))], "gid long, fuente string, rango int, cut_ipt string, geom GEOM")
    stored, keep = [], P.truncate_lineage
    monkeypatch.setattr(P, "truncate_lineage", lambda df: stored.append(df) or keep(df))
    placed = P.partition_shapes(comunas, features, None, 2_000.0)
    assert "strategy=merge" in stored[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.gid, r.a) for r in placed.groupBy("gid").agg({"area": "sum"}).toDF("gid", "a").collect()} == {(1, 16.0), (2, 45.0), (None, 39.0)}


def test_pyramid_reads_its_shapes_from_a_dealt_out_store(spark, monkeypatch):
    """F16: shapes are dealt out and stored before the first cut, which reads them a dozen times."""
    shapes = frame(spark, [(i, box(-71 + i / 100, -33, -71 + i / 100 + 0.004, -32.996)) for i in range(40)], "gid long, geom GEOM").coalesce(1)
    stored, keep = [], PY.truncate_lineage
    monkeypatch.setattr(PY, "truncate_lineage", lambda df: stored.append(keep(df)) or stored[-1])
    tiles = PY.tile_pyramid(shapes, "gid", (10, 11), whole=False)
    assert len(stored) == 3 and stored[0].columns == ["k", "geom"] and stored[0].rdd.getNumPartitions() == 4
    assert {r.gid for r in tiles.where("z = 11").collect()} == set(range(40))


def test_parcel_files_do_not_follow_the_number_of_comunas(spark, tmp_path):
    """without folders of comunas, 200 comunas take no more files than tasks; the comuna is a column that the scan prunes by."""
    lots = frame(spark, [(i, f"{i:05d}", box(i, 0, i + 0.5, 1)) for i in range(200)], "rid long, cut string, geom GEOM")
    sinks.write_parcels(lots, str(tmp_path / "p"), (0.0, 0.0, 201.0, 1.0), by_comuna=False)
    assert len(list((tmp_path / "p").rglob("*.parquet"))) <= 4 and not list((tmp_path / "p").glob("cut=*"))
    one = J.box_filter(spark.read.parquet(str(tmp_path / "p")).where("cut = '00010'"), 10.1, 0.0, 11.2, 0.5)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(cut)" in plan[plan.index("PushedFilters"):].split("\n")[0]
    assert [r.rid for r in one.collect()] == [10]


def test_crossing_rings_are_built_in_all_tasks(spark, monkeypatch):
    """a small file arrives in one split; the rings of 80 vertices are made and tested after dealing it out."""
    stored, keep = [], TQ.truncate_lineage
    monkeypatch.setattr(TQ, "truncate_lineage", lambda df: stored.append(keep(df)) or stored[-1])
    TQ.crossing(spark, "/root/testdata/sf0.001")
    assert stored[0].rdd.getNumPartitions() == 4


def test_documents_are_taken_apart_once(spark, monkeypatch):
    """one pass over the documents, without a branch for each level, and its nodes are stored."""
    docs = spark.createDataFrame([("a", '{"id":null,"m":[{"o":[1,{}]},null],"t":{}}'), ("b", "no"), ("c", None)], "archivo string, doc string")
    nodes = SR.document_nodes(docs)
    assert "Union" not in nodes._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.archivo, r.ruta, r.patron, r.tipo, r.n) for r in nodes.drop("v").collect()}
    assert got == {("a", "", "", "object", None), ("a", "/id", "/id", "null", None), ("a", "/m", "/m", "array", 2), ("a", "/m[0]", "/m[]", "object", None),
                   ("a", "/m[1]", "/m[]", "null", None), ("a", "/m[0]/o", "/m[]/o", "array", 2), ("a", "/m[0]/o[0]", "/m[]/o[]", "integer", None),
                   ("a", "/m[0]/o[1]", "/m[]/o[]", "object", None), ("a", "/t", "/t", "object", None), ("b", "", "", "ilegible", None), ("c", "", "", "ilegible", None)}
    stored, keep = [], SR.truncate_lineage
    monkeypatch.setattr(SR, "truncate_lineage", lambda df: stored.append(df) or keep(df))
    SR.schema_errors(docs, SR.SOURCE_RULES, SR.SOURCE_KEYS)
    assert len(stored) == 1


def test_affectations_do_not_cut_each_other(spark, monkeypatch):
    """ten affectations on one place leave as many trapezoids as their own outlines ask for, whatever lies beside them."""
    comunas = frame(spark, [("a", box(0, 0, 50, 100)), ("b", box(50, 0, 100, 100))], "cut string, geom GEOM")
    affectations = frame(spark, [(i, None if i % 2 else "a", box(10 + i, 10 + i, 60 + i, 60 + i)) for i in range(10)], "gid long, cut_ipt string, geom GEOM")
    stored, keep = [], P.truncate_lineage
    monkeypatch.setattr(P, "truncate_lineage", lambda df: stored.append(keep(df)) or stored[-1])
    got = {(r.gid, r.cut, r.area_m2) for r in P.clip_shapes(affectations, comunas, 2_000.0).collect()}
    assert got == {(i, "a", (40.0 - i) * 50) for i in range(10)} | {(i, "b", (10.0 + i) * 50) for i in range(1, 10, 2)}
    assert stored[0].count() == len(got)


def test_outlines_are_chained_in_batches(spark):
    """many shapes in one call, null keys among them, one row for each key."""
    cells = spark.range(200).selectExpr("IF(id % 50 = 0, NULL, id) AS gid", "id % 2 = 0 AS r", "10D AS area", "0D AS lo", "2D AS hi",
                                        "CAST(10 * id AS DOUBLE) AS xl0", "CAST(10 * id AS DOUBLE) AS xl1", "CAST(10 * id + 5 AS DOUBLE) AS xr0", "CAST(10 * id + 5 AS DOUBLE) AS xr1")
    out = shapes.dissolve(cells, ["gid", "r"])
    assert "MapInArrow" in out._jdf.queryExecution().optimizedPlan().toString()
    rows = {(r.gid, r.r): r.geom for r in out.collect()}
    assert len(rows) == 197 and len(rows[None, True]) == 4 and all(len(g) == 1 and len(g[0][0]) == 5 for k, g in rows.items() if k[0] is not None)


def test_layers_are_typed_once_each(spark):
    """F32: rows are counted by layer before a rule is tried, so the rules do not see the rows."""
    for query in (RQ.kept, RQ.type_counts):
        lines = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().split("\n")
        tried, counted = (max(i for i, line in enumerate(lines) if word in line) for word in ("RLIKE", "Aggregate"))
        assert tried <= counted      # children are printed below
    rows = [("IPT/PRC_Maule", 1, "PRC_Talca")] * 3 + [("IPT/PRDU_Norte", 1, "PRC_Talca"), ("IPT/PRC_Maule", 2, None)]
    typed = RQ.FE.typed_layers(spark.createDataFrame(rows, "service string, layer_id int, layer_name string"))
    assert {(r.service, r.layer_id, r.tipo, r.n) for r in typed.collect()} == {
        ("IPT/PRC_Maule", 1, "PRC", 3), ("IPT/PRDU_Norte", 1, "IGNORAR", 1), ("IPT/PRC_Maule", 2, "IGNORAR", 1)}


def test_unknown_descendants_are_not_shuffled(spark):
    """children beyond the ids of the registry go before the shuffle, and the pairs take one shuffle, by child."""
    rows = spark.createDataFrame([(i, ", ".join(str(10 * i + k) for k in range(10)) + ", x, 1, 1") for i in range(1, 40)] + [(40, None)], "id long, instrumentosDescendientesIds string")
    edges = R.descendant_edges(rows)
    plan = edges._jdf.queryExecution().executedPlan().toString()      # before it runs: the join by child that larger tables get
    assert "_lo" in plan and "hashpartitioning(parent" not in plan
    assert sorted((r.parent, r.child) for r in edges.collect()) == sorted({(i, c) for i in range(1, 40) for c in [*range(10 * i, 10 * i + 10), 1] if c <= 40})


def test_closure_of_forests_and_of_other_graphs(spark):
    """a forest, a cycle through its root, a self loop, and children with two parents give each (root, member) once."""
    def reached(edges, roots):
        todo, seen = [(r, r) for r in roots], set()
        while todo:
            pair = todo.pop()
            if pair not in seen:
                seen.add(pair)
                todo += [(pair[0], c) for p, c in edges if p == pair[1]]
        return sorted(seen)

    tree = [(1, 2), (1, 3), (2, 4), (4, 5), (5, 1), (7, 7)]
    for edges in (tree, [*tree, (3, 4), (7, 5), (3, 3)]):
        near = spark.createDataFrame(edges, "parent long, child long").groupBy("parent").agg({"child": "collect_set"}).toDF("parent", "children")
        got = R.closure(near, spark.createDataFrame([(1,), (2,), (7,), (9,)], "id long"))
        assert sorted((r.root, r.member) for r in got.collect()) == reached(edges, [1, 2, 7, 9])


def test_texts_are_folded_after_dealing_out(spark):
    """no folding in the task that reads, and the number of tasks follows the size also above what fills the cores."""
    lines = TX.fold_compatibility(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = next(i for i, line in enumerate(lines) if "Repartition" in line)
    assert not any(word in line for line in lines[dealt:] for word in ("RLIKE", "translate", "Filter"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert T.deal(docs, T.estimated_bytes(docs) // 10 + 1).rdd.getNumPartitions() == 10


def test_key_is_there_without_folding(spark):
    """the short answer equals that of the whole key, sign by sign."""
    signs = [(chr(c),) for c in [*range(0x250), 0x2002, 0x2163, 0x3042, 0xFF21]] + [(None,), ("",), (" _-",), ("日本",), ("_é",), ("日本 Ⅳ",)]
    rows = spark.createDataFrame(signs, "t string").select("t", X.has_key(F.col("t")).alias("a"), (F.length(X.norm_text(F.col("t"))) > 0).alias("b"))
    assert [r.t for r in rows.collect() if r.a != r.b] == []
