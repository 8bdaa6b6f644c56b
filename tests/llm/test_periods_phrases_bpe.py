"""BPE by speculation, runs from suffix classes and Toivonen's phrases against plain versions and on odd input."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonaria.llm import periods, phrases, queries, wordbpe
from tests.llm.test_llm_operators import ODD, corpus, empty, frame, odd


@pytest.fixture(scope="module")
def model():
    return wordbpe.WordBpe()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path(wordbpe.MODEL))


def ids_of(b):
    return np.frombuffer(b, "<u4").tolist()


# --- BPE -------------------------------------------------------------------------------------------------------------

def test_words_as_the_library_encodes_them(model, library):
    rng = random.Random(5)
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    near = [chr(c) for c in [*range(1, 0x600), *range(0x300, 0x370)]]
    texts = ["".join(rng.choices(every if k % 2 else near, k=rng.randint(1, 60))) for k in range(1500)]
    texts += ["".join(rng.choices("abcdet hinos'", k=rng.randint(1, 300))) for _ in range(500)]
    texts += ["it's we'll 's's ''s !'s <|startoftext|>x<|endoftext|> <|endoftext|", "ΟΔΟΣ Σ İstanbul", "aa" * 4000, "</w> </w></w>", "é<|endoftext|>́ \x00 \x1c \x85", ""]
    for text, ids in zip(texts, wordbpe.Encoder(model)(texts)):
        assert ids_of(ids) == library.encode(text, add_special_tokens=False).ids, text


def test_compatible_pairs_are_those_that_merging_leaves_alone(model):
    rng = np.random.default_rng(2)
    texts = [t for t in model.id_of if not t.endswith(wordbpe.END)]
    ends = [t for t in model.id_of if t.endswith(wordbpe.END)]
    a, b = [texts[i] for i in rng.integers(0, len(texts), 3000)], [ends[i] for i in rng.integers(0, len(ends), 3000)]
    a += ["a" * k for k in range(1, 4)] * 3
    b += ["a" * k + wordbpe.END for k in range(1, 4) for _ in range(3)]
    pairs = [(model.id_of[x], model.id_of[y], x + y) for x, y in zip(a, b) if x in model.id_of and y in model.id_of]
    got = model.compatible(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert [bool(g) for g in got] == [model.merged(w)[0] == [x, y] for x, y, w in pairs]


def test_merging_with_a_heap_is_merging_by_search(model, monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choices("aeionst", k=rng.randint(2, 40))) + wordbpe.END for _ in range(300)]
    plain = [model.merged(w) for w in words]
    monkeypatch.setattr(wordbpe, "SHORT", 0)
    assert [model.merged(w) for w in words] == plain


def test_encode_and_decode(spark, library):
    df = odd(spark)
    encoded = wordbpe.encode_words(df)
    rows = sorted(wordbpe.decode_words(encoded).collect(), key=str)
    assert len(rows) == df.count() and wordbpe.encode_words(empty(spark)).count() == 0
    texts = {r.gid: r.zona_desc or "" for r in df.where("gid <> 3").collect()}
    for r in rows:
        if r.gid in texts and r.gid is not None and r.gid != 3:
            want = library.encode(texts[r.gid], add_special_tokens=False).ids
            assert ids_of(r.ids) == want and r.zona_desc == library.decode(want, skip_special_tokens=False)
    assert [r.zona_desc for r in wordbpe.decode_words(encoded.limit(1).withColumn("ids", F.lit(None).cast("binary"))).collect()] == [""]


# --- runs ------------------------------------------------------------------------------------------------------------

def plain_runs(words, shortest=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(shortest, 2 * p):
                found.setdefault((i, j - i + p), p)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((i, n, p) for (i, n), p in found.items())


def test_runs_against_a_plain_search():
    rng = np.random.default_rng(4)
    for k in range(1200):
        n = int(rng.integers(1, 90))
        words = rng.integers(0, int(rng.integers(1, 5)), n)
        if k % 3 == 0:
            start, period = int(rng.integers(0, n)), int(rng.integers(1, n + 1))
            words = np.array([words[min(i if i < start else start + (i - start) % period, n - 1)] for i in range(n)])
        assert periods.runs_of(words) == plain_runs(words.tolist())


def test_ordered_positions_in_blocks(monkeypatch):
    monkeypatch.setattr(periods, "BLOCK", 8)
    rng = random.Random(3)
    numbers = rng.sample(range(1000), 300)
    held = periods.Positions(numbers[0])
    for k, x in enumerate(numbers[1:], 1):
        below, above = [y for y in numbers[:k] if y < x], [y for y in numbers[:k] if y > x]
        assert held.beside(x) == (max(below, default=-1), min(above, default=-1))
        held.add(x)
    assert list(held) == sorted(numbers) and len(held.blocks) > 20


def test_repeated_runs_of_a_table(spark):
    base = [f"p{i}" for i in range(40)]
    texts = [" ".join(base * 3 + ["fin"]), " ".join(["uno"] * 12 + base), " ".join(base), " ".join((base[:3] * 5) + (base[5:9] * 4))]
    df = odd(spark).unionByName(frame(spark, texts, 100))
    rows = periods.repeated_runs(df).collect()
    assert len(rows) == df.count() and periods.repeated_runs(empty(spark)).count() == 0
    by = {r.gid: r for r in rows if r.gid is not None and r.gid != 3}
    for gid, text in [(r.gid, r.zona_desc or "") for r in df.collect() if r.gid in by]:
        words = re.findall("[^\\x20\\x09-\\x0D]+", text)
        runs = plain_runs(words) if len(words) < 3000 else [(0, 3000, 1)]
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert [(r.inicio, r.largo, r.periodo) for r in by[gid].repeticiones] == runs
        assert by[gid].zona_desc == " ".join(w for i, w in enumerate(words) if i not in gone)
    with pytest.raises(ValueError):
        periods.repeated_runs(df, shortest=6)


def test_query_plants_and_finds_runs(spark):
    import zlib

    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate([*(" ".join(f"w{(i * k) % 17}" for i in range(k)) for k in range(60)), None])],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    planted = {r.doc_id: r.text for r in queries.with_planted_runs(docs).collect()}
    for r in docs.collect():
        words, h = (r.text or "").split(), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert planted[r.doc_id].split() == [words[i if i < a else a + (i - a) % p] for i in range(n)]
        else:
            assert planted[r.doc_id] == r.text


# --- phrases ---------------------------------------------------------------------------------------------------------

def plain_phrases(rows, least=30, top=2000):
    total, count = Counter(), defaultdict(Counter)
    for group, text in rows:
        group = group or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\\n\\x0b\\x0c\\r]", text):
            words = re.findall("[^\\x20\\x09]+", piece)
            total[group] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    count[group][tuple(words[i:i + size])] += 1
    out = []
    for group, f in count.items():
        often = {p: a for p, a in f.items() if a >= least}
        kept = []
        for p, a in often.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(group, i + 1, p.decode(), -a, l, r, total[group], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.mark.parametrize("sample_of", [1, 8, 10_000])
def test_collocations_against_plain_counts(spark, monkeypatch, sample_of):
    """The sample holds all, some or none of the texts: the result is the same."""
    monkeypatch.setattr(phrases, "SAMPLE_OF", sample_of)
    rng = np.random.default_rng(6)
    words = ["Zona", "de", "la", "altura", "máxima", "ñuñoa", "x,", "y.", "fin;\n", "a\tb"]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(1, 60)), p=[.2, .2, .1, .1, .1, .05, .05, .05, .05, .1])), ["es", "en", None][i % 3], "f") for i in range(240)]
    rows += [(None, None, None, None), (3, "", "es", "f"), (3, "zona de la altura", "es", "f")]
    df = spark.createDataFrame(rows, "gid long, zona_desc string, idioma string, grupo string")
    got = phrases.collocations(df, top=25).collect()
    assert sorted(tuple(r) for r in got) == plain_phrases([(r[2], r[1]) for r in rows], top=25) and len(got) > 30


def test_collocations_of_odd_input(spark):
    df = odd(spark).withColumn("idioma", F.lit("es")).withColumn("frase", F.lit(1)).withColumn("_sample", F.lit(2))
    rows = phrases.collocations(df).collect()
    assert [(r.frase, r.a, r.l, r.r) for r in rows][:1] == [("uno uno uno uno", 2997, 2999, 2999)] or rows[0].frase.startswith("uno uno")
    assert phrases.collocations(empty(spark).withColumn("idioma", F.lit("es"))).count() == 0


def test_batches_that_hold_common_phrases_back(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BATCH", 2_000)
    monkeypatch.setattr(phrases, "HELD", 5)
    monkeypatch.setattr(phrases, "SENT", 3)
    rows = [(i, f"muro alto y techo rojo {i % 7} muro alto", "es") for i in range(90)]
    df = spark.createDataFrame(rows, "gid long, zona_desc string, idioma string")
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == plain_phrases([(r[2], r[1]) for r in rows])


def test_query_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Zona A zona A", "es", "s", 1), (2, None, None, "s", 0)], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    runs = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert all(r.n_runs == 0 and r.start is None and r.runs_sha256 == hashlib.sha256(b"").hexdigest() for r in runs)
    two = {r.doc_id: r for r in queries.op11_bpe(spark, str(tmp_path)).collect()}
    assert two[2].n_tokens == 0 and two[2].ids_sha256 == two[2].decoded_sha256 == hashlib.sha256(b"").hexdigest() and two[1].n_tokens == 4
    assert queries.op13_phrase_collocations(spark, str(tmp_path)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
