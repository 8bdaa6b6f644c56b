"""Findings of round 4."""
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from helpers import box, frame, ring
from suite import overlay_queries as OQ
from zonaria.llm import phrases
from zonaria.operators import overlay as V
from zonaria.operators import partition as P
from zonaria.operators import tiling as T


def test_phrases_are_not_broadcast(spark, monkeypatch):
    """tables of phrases grow with the corpus, however small their files look: no join broadcasts one, even where all of them
    are tiny. The sample is empty, so that phrases fail too."""
    monkeypatch.setattr(phrases, "SAMPLE_OF", 10_000)
    kept, keep = [], phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda df: kept.append(df) or keep(df))
    df = spark.createDataFrame([(i, "muro alto y techo rojo, muro alto", "es") for i in range(40)], "gid long, zona_desc string, idioma string")
    out = phrases.collocations(df)
    assert {(r.frase, r.a) for r in out.collect()} >= {("muro alto", 80), ("muro alto y techo", 40)}
    joins = [line for plan in [*kept, out] for line in re.findall(r".*\bJoin .*", plan._jdf.queryExecution().optimizedPlan().toString())]
    assert len(joins) >= 5 and all("strategy=merge" in line for line in joins), joins
    assert "Broadcast" not in "".join(plan._jdf.queryExecution().executedPlan().toString() for plan in [*kept, out])


def test_parts_are_the_trapezoids_of_their_covering_set(spark):
    """a row per covering set holds the same trapezoids as a row for each; tall ones cover the same ground."""
    shapes = [("a", box(0, 0, 10, 10)), ("b", box(4, 2, 6, 7)), ("c", box(4, 7, 6, 9)), ("d", [[ring((1, 1), (9, 3), (2, 8))]]), ("e", [[ring((12, 0), (13, 25), (14, 0))]])]
    layers = frame(spark, shapes, "k string, geom GEOM").select(F.struct("k").alias("item"), "geom")
    key = lambda r: (r.tx, r.ty, tuple(sorted(a.k for a in r.active)))
    want = Counter((key(r), tuple(round(r[c], 6) for c in V.PART)) for r in V.overlay(layers, 20.0, shapes=True).collect())
    flat, tall = (V.overlay(layers, 20.0, parts=kind).collect() for kind in ("flat", "tall"))
    assert len({key(r) for r in flat}) == len(flat)
    assert Counter((key(r), tuple(round(p[c], 6) for c in V.PART)) for r in flat for p in r.parts) == want

    def ground(rows):
        """Area and first moments of each covering set."""
        out = defaultdict(lambda: [0.0] * 3)
        for k, p in rows:
            area, lo, hi, l0, l1, r0, r1 = p
            w0, w1, h = r0 - l0, r1 - l1, hi - lo
            moment_y = h * (lo * (w0 + w1) / 2 + h * (w0 + 2 * w1) / 6)
            moment_x = h * ((r0 * r0 + r0 * r1 + r1 * r1) - (l0 * l0 + l0 * l1 + l1 * l1)) / 6
            for i, v in enumerate((h * (w0 + w1) / 2, moment_x, moment_y)):
                out[k][i] += v
            assert abs(area - h * (w0 + w1) / 2) < 1e-9
        return {k: [round(v, 6) for v in m] for k, m in out.items()}

    joined = [(key(r), tuple(p[c] for c in V.PART)) for r in tall for p in r.parts]
    assert ground(joined) == ground([(key(r), tuple(p[c] for c in V.PART)) for r in flat for p in r.parts])
    assert {key(r): round(r.area, 6) for r in tall} == {k: m[0] for k, m in ground(joined).items()}
    assert len(joined) < sum(want.values())
    lone = [p for k, p in joined if k[2] == ("e",)]
    assert len(lone) == 2                    # one for each of its tiles, whatever stands beside it


def test_overlap_is_measured_on_tall_trapezoids(spark, monkeypatch):
    """the union of the finished ground gets it in a fraction of the trapezoids, with the same area for every winner."""
    given = []
    monkeypatch.setattr(OQ.P, "overlap_quality", lambda pieces, *a: given.append(pieces) or pieces)
    OQ.overlap(spark, "/root/testdata/sf0.001")
    comunas, feat, risks = OQ.layers(spark, "/root/testdata/sf0.001")
    whole = P.partition_shapes(comunas, feat, risks, OQ.TILE)
    assert 3 * given[0].count() < whole.count()
    sums = lambda df: {tuple(r) for r in df.groupBy("cut", "clase", "gid", "riesgo").agg(F.sum("area")).collect()}
    assert sums(P.partition_shapes(comunas, feat, risks, OQ.TILE, tall=True)) == sums(whole)


def test_load_of_tiles_reads_the_shapes_once(spark):
    shapes = frame(spark, [(1, box(0, 0, 1, 1)), (2, box(0, 0, 30, 30))], "gid long, geom GEOM")
    load = T.tile_load(shapes, 7.0)
    assert len(re.findall("LogicalRDD|LocalRelation", load._jdf.queryExecution().optimizedPlan().toString())) == 1
    assert {(r.tx, r.ty): r.n for r in load.collect()}[(0, 0)] == 6
