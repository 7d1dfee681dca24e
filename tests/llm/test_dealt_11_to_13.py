"""Packing, vector codes and periodic runs: brute force, the SQL of the codes, odd rows and empty tables."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import queries
from starloom.llm.packing import BITS, LENGTH, Packer, coder, hilbert_key, pack, points
from starloom.llm.periodic_runs import Codes, collapsed, find_runs, periodic_runs
from starloom.llm.vector_codes import HEAVY, Slices, compress, with_label_totals
from tests.conftest import SMALL

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<float>, label int, code string, error int, vector string, __label int"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


# -- packing ---------------------------------------------------------------------------


def whole(rows, ids_of):
    """Checks that pieces are each document's ids once, and sequences without gaps."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, wanted in ids_of.items():
        own = sorted(pieces.pop(doc), key=lambda r: r.start)
        assert {r.doc_tokens for r in own} == {len(wanted)}
        at = 0
        for r in own:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(wanted[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(wanted)
    assert not pieces
    short = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == LENGTH or (at < LENGTH and at & (at - 1) == 0)  # nothing to pad
        short += at < LENGTH
    return short


def test_packing_holds_every_id_once(spark, texts):
    library = Tokenizer.from_file(VOCABULARY)
    ids = {d: library.encode(t, add_special_tokens=False).ids + [1] for d, t in texts.items()}
    rows = queries.op11_packing(spark, SMALL).collect()
    tasks = len({r.sequence_id >> 36 for r in rows})
    assert whole(rows, ids) <= tasks * LENGTH.bit_length()


def test_ids_are_the_librarys():
    library, own = Tokenizer.from_file(VOCABULARY), coder(VOCABULARY)
    draw = random.Random(4)
    samples = ["", " ", "<|endoftext|>", "a<|endoftext|> b<|endoftext", "x" * 3000, " \n\n\t a", "it's I'LL 12 ½ x²"]
    samples += ["".join(chr(draw.choice([32, 10, draw.randrange(33, 127), draw.randrange(160, 0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(60)) for _ in range(300)]
    for text in samples:
        assert own.encode(text, allowed_special="all") == library.encode(text, add_special_tokens=False).ids


def test_neighbours_on_the_curve_are_neighbours_in_space():
    side = np.arange(16)
    grid = np.stack(np.meshgrid(side, side, side, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert_key(grid, 4)
    assert sorted(key.tolist()) == list(range(16**3))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_points_depend_on_the_text_alone():
    raws = [b"", b"  \n", b"A b\tc", b"a B c", b"words of another kind entirely", b"x" * 9_000_000, b"long words " * 900_000]
    together = points(raws)
    assert (together == np.concatenate([points([r]) for r in raws])).all()
    assert (together[2] == together[3]).all() and (together[0] == together[1]).all()
    assert together.min() >= 0 and together.max() < 1 << BITS


def test_packer_cuts_the_rest_into_powers_of_two():
    for n in (0, 1, 7, 2047, 2048, 2049, 5000):
        packer = Packer()
        packer.add("d", np.arange(n, dtype="<u4"))
        packer.finish()
        sizes = collections.Counter()
        for _, _, length, _, sequence, _, _ in packer.taken():
            sizes[sequence] += length
        rest = [v for v in sizes.values() if v != LENGTH]
        assert sum(sizes.values()) == n and len(set(rest)) == len(rest) and all(v & (v - 1) == 0 for v in rest)


def test_packing_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (None, "a b"), (None, None), (3, "word " * 30_000), (4, "y" * 70_000)] + [(None, "same")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as curve", "2 as ids", "3 as place", "4 as part")
    got = pack(docs.repartition(3), VOCABULARY).collect()
    assert {(r.doc_id, r.doc_tokens) for r in got if r.doc_id in (1, 2)} == {(1, 1), (2, 1)}
    library = Tokenizer.from_file(VOCABULARY)
    assert sum(r.length for r in got) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert all(len(r.ids) == 4 * r.length for r in got)
    again = pack(docs.repartition(3), VOCABULARY).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert pack(docs.limit(0), VOCABULARY).count() == 0


def test_equal_texts_without_id_are_dealt_over_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.range(2000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one text' AS text")
        per_task = collections.Counter(r.sequence_id >> 36 for r in pack(docs, VOCABULARY).collect())
        assert len(per_task) >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


# -- vector codes ----------------------------------------------------------------------


def brute_codes(rows, rounds=2):
    """(vec_id, code, error, label_error) by measuring every part against every entry."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: r[0])
    whole = np.array([np.floor(256 * np.array(r[1], np.float64)) for r in kept]).astype(np.int64)
    parts = np.stack(np.split(whole, 16, axis=1), axis=1)
    books = parts[:64].copy()  # entry, part, dimension

    def nearest(p):
        d = np.square(parts[:, None, p] - books[None, :, p]).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        fresh = books.copy()
        for p in range(16):
            code, _ = nearest(p)
            for e in set(code.tolist()):
                own = parts[code == e, p]
                fresh[e, p] = own.sum(axis=0) // len(own)
        books = fresh
    pairs = [nearest(p) for p in range(16)]
    codes, errors = np.stack([c for c, _ in pairs], 1), sum(d for _, d in pairs)
    totals = collections.Counter()
    for r, e in zip(kept, errors.tolist()):
        totals[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for p in range(16) for x in books[:, p].ravel().tolist()).encode()).hexdigest()
    return {(r[0], bytes(c.tolist()).hex(), e, totals[r[2]], digest) for r, c, e in zip(kept, codes, errors.tolist())}


def test_vector_codes_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    names = "vec_id, code, error, label_error, codebooks_sha256"
    want = set(con.sql(f"SELECT {names} FROM ({queries.ORACLE['op12_vector_codes']})").fetchall())
    assert set(map(tuple, queries.op12_vector_codes(spark, SMALL).selectExpr(*names.split(", ")).collect())) == want


@pytest.mark.parametrize("n, size", [(300, 16), (200, 64), (5, 32), (1, 16)])
def test_vector_codes_match_brute_force(spark, n, size):
    draw = np.random.default_rng(n)
    rows = [(i, draw.choice([-0.5, 0.0, 0.25, draw.normal()], size).astype(np.float32).tolist(), None if i % 3 == 0 else i % 5) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] * size, 1), (-1, [float("nan")] * size, 1), (-2, [float("inf")] + [0.0] * (size - 1), 2)]
    frame = spark.createDataFrame([(*r, "c", 0, "v", 1) for r in rows], VECTORS).repartition(3)
    assert set(map(tuple, compress(frame).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())) == brute_codes(rows)


def test_candidates_hold_the_nearest_entry():
    draw = np.random.default_rng(3)
    for m in (1, 2, 63, 64):
        entries = draw.integers(-20, 20, (m, 3))
        points_ = draw.integers(-40, 40, (500, 3))
        index, least = Slices(entries).nearest(points_)
        distance = np.square(points_[:, None] - entries[None]).sum(axis=2)
        assert (index == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_vector_codes_odd_rows(spark):
    unit = [1.0] * 16
    rows = [(None, unit, None), (None, unit, None), (1, unit, 1), (1, [2.0] * 16, 1), (2, [0.5] * 7, 1), (3, [], 1), (4, [1e30] * 16, 1)]
    frame = spark.createDataFrame([(*r, "c", 0, "v", 1) for r in rows], VECTORS)
    got = sorted((r.vec_id or 0, r.code, r.error, r.label_error) for r in compress(frame).collect())
    assert [(i, e, t) for i, _, e, t in got] == [(0, 0, 0), (0, 0, 0), (1, 0, 0), (1, 0, 0)]
    assert len({c for _, c, _, _ in got}) == 2
    short = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1, "c", 0, "v", 1)], VECTORS)  # filled up to 16 parts
    assert [(r.vec_id, r.error) for r in compress(short).collect()] == [(1, 0)]
    assert compress(frame.limit(0)).count() == 0


def test_label_totals_of_common_and_rare_labels(spark):
    rows = spark.range(3 * HEAVY).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN -1L ELSE id END AS label", "id AS error")
    got = {r.id: r.label_error for r in with_label_totals(rows).collect()}
    sums = [sum(range(k, 3 * HEAVY, 3)) for k in (0, 1)]
    assert got == {i: sums[i % 3] if i % 3 < 2 else i for i in range(3 * HEAVY)}


# -- periodic runs ---------------------------------------------------------------------


def brute_runs(words):
    """Maximal stretches of every period, those of a smaller period left out."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        equal = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            elif not same and start is not None:
                length = i - start + q
                stretch = words[start : start + length]
                if length >= max(6, 4 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found.append((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periodic_runs_match_brute_force(spark, texts):
    short = {d: t for d, t in texts.items() if len(t.split()) < 1500}
    rows = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SMALL).collect()}
    assert set(rows) == set(texts)
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    for doc, text in short.items():
        assert tuple(rows[doc][n] for n in names) == brute_row(doc, text)
    assert sum(r.n_runs > 0 for r in rows.values()) >= 10


def test_runs_of_random_words():
    draw = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(1, 4)):
            words, letters = [], draw.choice(["ab", "abc", "abcdefghij"])
            for _ in range(draw.randint(0, 6)):
                unit = [draw.choice(letters) for _ in range(draw.choice([1, 2, 3, 4, 5, 6, 7, 18, 19, 20, 58]))]
                words += (unit * 7)[: draw.randint(1, 7 * len(unit))]
            texts.append(words[:500])
        codes = Codes()
        flat = np.array([codes[w] for t in texts for w in t], np.int64)
        assert find_runs(flat, np.array([len(t) for t in texts], np.int64)) == [brute_runs(t) for t in texts]


def test_a_long_text_of_one_word_takes_one_run():
    codes = np.zeros(2_000_000, np.int64)
    assert find_runs(codes, np.array([2_000_000])) == [[(0, 2_000_000, 1)]]
    assert collapsed([b"x"] * 9, [(0, 9, 1)]) == b"x"


def test_periodic_runs_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 8), (None, "a " * 8), (5, "x" * 70_000), (6, "one\x1ctwo three " * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as n_words", "3 as h", "'c' as collapsed")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()]
    assert got == [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 8, [(0, 8, 1)], "a"), (None, 8, [(0, 8, 1)], "a"), (5, 1, [], "x" * 70_000),
        (6, 6, [(0, 6, 1)], "one\x1ctwo three"),
    ]
    assert periodic_runs(docs.limit(0)).count() == 0
