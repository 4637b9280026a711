"""Each operator against a brute-force version, on a table of odd rows and on empty tables."""

import base64
import collections
import hashlib
import io
import itertools
import math
import re
import struct
import time
import zipfile
import zlib

import numpy as np
import pytest

from tessera.llm import hmm_lm, jaccard_bayes, lz_fingerprint, mixing, pii_gbt, quality_mcd, sharding, sp_nbest, warc_zip
from tessera.llm.common import LOWER, SPACES, UPPER
from tessera.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = str.maketrans(UPPER, LOWER)


def rows_of(spark, base, name, table="documents"):
    return [r.asDict() for r in QUERIES[name](spark, base).collect()]


@pytest.fixture(scope="module")
def docs(spark, messy_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{messy_dir}/documents.parquet").select("doc_id", "text").collect()]


def texts_by_id(docs):
    """Texts of ids that one row has, or several equal ones."""
    out = collections.defaultdict(set)
    for i, t in docs:
        out[i].add(t)
    return {i: next(iter(t)) or "" for i, t in out.items() if len(t) == 1}


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_empty_results(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def luhn(s):
    return sum(x if k % 2 == 0 else 2 * x - 9 * (2 * x > 9) for k, x in enumerate(map(int, reversed(s)))) % 10 == 0


def brute_spans(text):
    wanted = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in wanted.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark, messy_dir, docs):
    got = rows_of(spark, messy_dir, "op1_gbt_pii")
    assert len(got) == len(docs)
    texts = texts_by_id(docs)
    seen = 0
    for r in got:
        if r["doc_id"] in texts:
            spans = brute_spans(texts[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), (r, spans)
            assert [r[f"n_{k}"] for k in pii_gbt.KINDS] == [sum(s.startswith(k) for s in spans) for k in pii_gbt.KINDS]
            assert set(spans) <= set(r["spans"].split(","))
            seen += len(spans)
    assert seen >= 8


def test_pii_redaction_and_added_spans(spark):
    good = [f"pay by card {4111111111110000 + k} please" for k in range(3000)]
    rows = [(i, t) for i, t in enumerate(good)] + [(5000, "call +1 (487) 555-7209 or a@b.cd!"), (5001, "my card 4111.1111.1111.1111 is new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii_gbt.cut_lineage(pii_gbt.generate(docs, keep=["doc_id", "text"]))
    trees, cuts = pii_gbt.fit(spans)
    out = {r["i"]: r for r in pii_gbt.select(spans, (trees, cuts)).selectExpr("doc.doc_id i", "doc.text t", "base", "spans").collect()}
    assert trees and 2 in cuts
    assert len(out[5001]["base"]) == 0 and len(out[5001]["spans"]) == 1  # the model adds a card that is written with dots
    wrong = [r for i, r in out.items() if i < 3000 and len(r["spans"]) != len(r["base"])]
    assert not wrong
    redacted = pii_gbt.select(spans, (trees, cuts)).where("doc.doc_id = 5000").select(pii_gbt.redact(pii_gbt.F.col("doc.text"), pii_gbt.F.col("spans"))).first()[0]
    assert redacted == "call [PII] or [PII]!"


def added_spans(spark, rows):
    """Thresholds, and for each id from 5000 on the added stretches by kind."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii_gbt.cut_lineage(pii_gbt.generate(docs, keep=["doc_id", "text"]))
    trees, cuts = pii_gbt.fit(spans)
    out = pii_gbt.select(spans, (trees, cuts)).where("doc.doc_id >= 5000").collect()
    return cuts, {r["doc"]["doc_id"]: {(pii_gbt.KINDS[x["k"]], r["doc"]["text"][x["start"] : x["end"]]) for x in r["spans"] if x not in r["base"]} for r in out}


def test_pii_every_kind_gets_a_threshold(spark):
    rows = [(i, f"write to john{i}.b@mail{i % 90}.{['com', 'org', 'net'][i % 3]} soon, host 10.0.{i % 200}.7, call +1 (487) 555-{1000 + i} now") for i in range(600)]
    rows += [(5000, "ask john at example dot com today"), (5001, "or john [at] x [dot] org instead"), (5002, "he works at home dot matrix printers")]
    cuts, added = added_spans(spark, rows)
    assert {0, 1, 3} <= set(cuts)
    assert added == {5000: {("email", "john at example dot com")}, 5001: {("email", "john [at] x [dot] org")}, 5002: set()}


def test_pii_numbers_beside_numbers(spark):
    rows = [(i, f"call +1 (487) 555-{1000 + i} or 555-{1000 + i} now") for i in range(600)]
    texts = ["555-123-4567 555-987-6543 555-222-3333", "room 12 555-123-4567", "at 4111 1111 1111 1111. 555-987-6543", "no 555-123-4567x"]
    docs = spark.createDataFrame(rows + [(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    made = pii_gbt.cut_lineage(pii_gbt.generate(docs, keep=["doc_id", "text"]))
    proposed = {r["doc"]["doc_id"] - 5000: {(pii_gbt.KINDS[x["k"]], r["doc"]["text"][x["start"] : x["end"]]) for x in r["proposed"]} for r in made.where("doc.doc_id >= 5000").collect()}
    assert {("phone", x) for x in texts[0].split(" ")} <= proposed[0] and {("phone", "555-123-4567")} <= proposed[1]
    assert ("phone", "555-987-6543") in proposed[2] and not any("1111 1111" in s and k == "card" for k, s in proposed[2])
    assert ("phone", "1111 1111") not in proposed[2] and not any(s.endswith("4567") for _, s in proposed[3])
    for i, t in enumerate(texts):  # every stretch between ends of groups
        ends = [m.span() for m in re.finditer("[0-9]+", t)]
        want = {t[a:b] for (a, _), (_, b) in itertools.product(ends, ends) if a < b and 7 <= len(re.sub("[^0-9]", "", t[a:b])) <= 15 and not re.search("[A-Za-z]", t[a : b + 1])}
        assert {s for k, s in proposed[i] if k == "phone"} == {s for s in want if i != 2 or not set(re.findall("[0-9]+", s)) <= {"4111", "1111"}}
    _, added = added_spans(spark, rows + [(5000, texts[0]), (5001, texts[1])])
    assert {("phone", x) for x in texts[0].split(" ")} <= added[5000] and ("phone", "555-123-4567") in added[5001]
    assert ("phone", "123-4567") not in added[5001]  # tied to the group before


def test_sharding(spark, messy_dir, docs):
    got = rows_of(spark, messy_dir, "op2_external_shuffle")
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(40)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    place = lambda rows: sorted((r["text_crc32"], r["shard"], r["slot"]) for r in rows)
    assert place(got) == place(rows_of(spark, messy_dir, "op2_external_shuffle"))


def test_sharding_splits_equal_rows(spark):
    same = spark.createDataFrame([(1, "x" * 100)] * 4000 + [(i, "y") for i in range(50)], "doc_id long, text string")
    out = sharding.external_shuffle(same, "text", 7, bucket_bytes=10_000)
    assert out.select("shard", "slot").distinct().count() == 4050


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(0)
    seen = collections.Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


def test_hmm_recursions_match_plain_loops():
    rng = np.random.default_rng(0)
    model = hmm_lm.reestimated(rng.random(3), rng.random((3, 3)), rng.random((3, 9)), rng.dirichlet(np.ones(9)))
    lengths = np.array([1, 5, 512, 513, 200, 1700])
    symbols = rng.integers(0, 9, lengths.sum()).astype(np.int32)
    r = hmm_lm.Recursion(model, symbols, lengths)
    likely = r.likelihoods()
    first, move, emit, total = r.expected(9)
    want_move, want_emit, at = np.zeros((3, 3)), np.zeros((3, 9)), 0
    for k, n in enumerate(lengths):
        x = symbols[at : at + n]
        at += n
        alphas, log = [model["start"]], 0.0
        for s in x:
            a = (alphas[-1] @ model["move"]) * model["emit"][:, s]
            log += math.log(a.sum())
            alphas.append(a / a.sum())
        betas = [np.ones(3)]
        for s in x[::-1]:
            b = model["move"] @ (model["emit"][:, s] * betas[0])
            betas.insert(0, b / b.sum())
        for t, s in enumerate(x):
            p = alphas[t][:, None] * model["move"] * (model["emit"][:, s] * betas[t + 1])[None]
            want_move += p / p.sum()
            want_emit[:, s] += (p / p.sum()).sum(0)
        assert likely[k] == pytest.approx(log, abs=1e-8)
    np.testing.assert_allclose(move, want_move, atol=1e-8)
    np.testing.assert_allclose(emit, want_emit, atol=1e-8)
    assert first.sum() == pytest.approx(len(lengths)) and total == pytest.approx(likely.sum())


def test_hmm_training_raises_likelihood():
    rng = np.random.default_rng(1)
    # two states that take turns
    x = np.array([rng.integers(0, 5) + 5 * (t % 2) for t in range(4000)], np.int32)
    uni = np.full(10, 0.1)
    model, seen = hmm_lm.new_model(uni, 2), []
    for _ in range(60):
        f, m, e, total = hmm_lm.Recursion(model, x, np.array([4000])).expected(10)
        seen.append(total)
        model = hmm_lm.reestimated(f, m, e, uni)
    assert seen[-1] > seen[0] + 1000


def test_hmm_scores_beat_one_state(spark, monkeypatch):
    """Words of two sets that take turns: the next set is known, so a word is worth a bit less on documents held out."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"{'ab'[t % 2]}{rng.integers(0, 20)}" for t in range(100))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def held():
        got = hmm_lm.score_documents(docs).where("held_out").collect()
        return sum(r["score"] for r in got) / sum(r["n_tokens"] for r in got)

    full = held()
    monkeypatch.setattr(hmm_lm, "STATES", 1)
    assert full - held() > 0.25  # log10(2) is 0.301


def test_lm_base_scores(spark, messy_dir, docs):
    got = rows_of(spark, messy_dir, "op3_hmm_scores")
    assert len(got) == len(docs)
    tokens = lambda t: WORD.findall((t or "").translate(TO_LOWER)) + ["\n"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, t in docs if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    texts = texts_by_id(docs)
    for r in got:
        assert r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == n
        if r["doc_id"] in texts:
            words = tokens(texts[r["doc_id"]])
            assert (r["n_tokens"], r["n_known"]) == (len(words), sum(counts[w] > 0 for w in words))
            assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
            assert r["score"] < 0 and math.isfinite(r["score"])


def test_line_dedup(spark, messy_dir, docs):
    holders = collections.defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(TO_LOWER)
    for i, t in docs:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 40:
                    holders[key(line)].add(i)
    want = collections.Counter()
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < 5 or max(holders[key(x)]) == i]
        want[i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    got = rows_of(spark, messy_dir, "op4_line_dedup")
    assert collections.Counter(tuple(r.values()) for r in got) == want
    assert sum(r["n_dropped"] for r in got) == 21


@pytest.fixture(scope="module")
def pieces():
    with open(sp_nbest.default_model(), "rb") as f:
        return sp_nbest.Pieces(f.read())


@pytest.mark.parametrize("text", ["thing en er", "a b  c", "ation é x", "\n\n", "ab😀"])
def test_n_best_matches_enumeration(pieces, text):
    def paths(s, at=0):
        if at == len(s):
            yield 0.0, ()
            return
        for end, ids, score in pieces.edges_at(s, at):
            for rest, more in paths(s, end):
                yield score + rest, ids + more

    want = sorted(paths(" " + text), reverse=True)[:6]
    got = pieces.encode(text, 6)
    assert [x for x, _ in got] == pytest.approx([x for x, _ in want])
    assert len({tuple(ids) for _, ids in got}) == len(got)
    assert all(pieces.decode(ids) == text for _, ids in got)


def test_pieces_round_trip(spark, messy_dir, docs, pieces):
    got = rows_of(spark, messy_dir, "op5_nbest_pieces")
    assert len(got) == len(docs) and all(r["round_trip"] for r in got)
    texts = texts_by_id(docs)
    for r in got:
        if r["doc_id"] in texts and len(texts[r["doc_id"]]) < 2000:
            ids = pieces.encode(texts[r["doc_id"]], 1)[0][1]
            assert (r["n_pieces"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            digests = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for _, x in pieces.encode(texts[r["doc_id"]], 4)]
            assert r["all_sha256"] == digests and len(set(digests)) == len(digests)


@pytest.mark.parametrize("text", ["x" * 2_000, "x" * 30_000, "ab" * 3_000, "=-" * 4_000, "." * 5_000])
def test_runs_of_ties_end_soon(pieces, text):
    began = time.monotonic()
    found = pieces.encode(text, 4)
    assert time.monotonic() - began < 10
    assert len({tuple(ids) for _, ids in found}) == 4 and all(pieces.decode(ids) == text for _, ids in found)
    assert [score for score, _ in found] == pytest.approx(sorted((score for score, _ in found), reverse=True))


def test_archives(spark, messy_dir):
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{messy_dir}/pages.parquet").collect()]
    first = {}
    for i, p in pages:
        if i is not None:
            first[p] = min(i, first.get(p, i))
    want = collections.Counter()
    for i, p in pages:
        revisit = p in first and first[p] != i
        want[i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", first[p] if revisit else None] += 1
    assert collections.Counter(tuple(r.values()) for r in rows_of(spark, messy_dir, "op6_zip_warc")) == want


def test_payloads_come_back(spark, messy_dir):
    pages = spark.read.parquet(f"{messy_dir}/pages.parquet")
    out = warc_zip.read_archives(warc_zip.archive_pages(pages), payloads=True).where("record_type = 'response'").collect()
    assert {bytes(r["payload"]) for r in out} == {(r["html"] or "").encode() for r in pages.collect()}


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", b"first member")
        z.writestr("päth/b.txt", b"x" * 5000, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 in a comment"
    raw = out.getvalue()
    assert b"PK\x06\x06" in raw and struct.unpack("<I", b"PK\x06\x07")[0]
    read_at = lambda at, n: raw[at : at + n]
    found = warc_zip.zip_members(read_at, len(raw))
    assert warc_zip.member_bytes(read_at, found["a.txt"]) == b"first member"
    assert warc_zip.member_bytes(read_at, found["päth/b.txt"]) == b"x" * 5000
    with pytest.raises(ValueError):
        warc_zip.zip_members(lambda at, n: raw[:40][at : at + n], 40)


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark, messy_dir, docs):
    rows = spark.read.parquet(f"{messy_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    target = brute_targets(sizes)
    got = rows_of(spark, messy_dir, "op7_block_mix")
    assert len(got) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in got)
    taken = collections.Counter()
    for r in got:
        source = next(s for s in sizes if sizes[s] == r["source_size"])
        assert r["target"] == pytest.approx(target[source])
        taken[source] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, rows_of(spark, messy_dir, "op7_block_mix")))


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 1, "b": 1}, {"a": 0, "b": 7}, {"z": 100, "é": 5, "Z": 5, "y": 900}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_permutation(spark):
    for n in (1, 2, 3, 7, 50, 333):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(mixing.F.col("id"), mixing.F.lit(n).cast("long"), mixing.F.lit(5))).collect()]
        assert sorted(got) == list(range(n)) and (n < 7 or got != sorted(got))


def test_mixed_documents(spark, messy_dir):
    docs = spark.read.parquet(f"{messy_dir}/documents.parquet")
    words = {}
    for r in docs.collect():
        words.setdefault(r["doc_id"], set()).update(WORD.findall(r["text"] or ""))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert all(set(WORD.findall(r["text"] or "")) <= words[r["doc_id"]] and r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    bare = lambda rows: sorted(str((r["doc_id"], r["text"])) for r in rows if not WORD.search(r["text"] or ""))
    assert bare(got) == bare(docs.collect())
    total = sum(len(WORD.findall(r["text"] or "")) for r in docs.collect())
    assert abs(sum(len(WORD.findall(r["text"] or "")) for r in got) - total) <= 8


def test_mixing_small_sources_and_repeated_rows(spark, tmp_path):
    """Sources under a block get their words; a third of the table is one row repeated; the copies share a source's
    words as other documents do, and no number of partitions changes the result."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40)), "big") for i in range(100)]
    rows += [(500, "again and again the same words " * 5, "big")] * 60
    rows += [(600, "tiny source", "s1"), (601, "five words of its own", "s2"), (602, " ".join("abc") * 40, "s3"), (603, None, "s4"), (604, "no source here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target = brute_targets(sizes)
    results = []
    for parts in (1, 5):
        docs.repartition(parts).write.parquet(f"{tmp_path}/{parts}/documents.parquet")
        got = mixing.op7_block_mix(spark, f"{tmp_path}/{parts}").collect()
        source_of = {r[0]: r[2] for r in rows}
        taken = collections.Counter()
        for r in got:
            taken[source_of[r["doc_id"]]] += r["taken"]
        assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes) and len(got) == len(rows)
        results.append(sorted(map(str, got)))
    assert results[0] == results[1]
    mixed = mixing.mixed_documents(docs).collect()
    counted = collections.Counter()
    for r in mixed:
        counted[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert all(abs(counted[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)
    assert [r for r in mixed if r["doc_id"] == 603] == [(603, None, "s4")]


def test_copies_of_a_row_are_numbered_across_parts(spark):
    rows = spark.createDataFrame([(k % 3, 1, k % 4) for k in range(60)], "h long, h2 long, part int")
    got = sorted((r["h"], r["copy"]) for r in mixing.copy_numbers(rows).collect())
    assert got == [(h, c) for h in range(3) for c in range(20)]


def test_pruning_thresholds_follow_the_posterior():
    for n, least in jaccard_bayes.least_matches(0.8, 1e-6):
        tail = lambda m, n=n: sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(least) >= 1e-6 and (least == 0 or tail(least - 1) < 1e-6)


def test_near_duplicates(spark, messy_dir, docs):
    sets = []
    for _, t in docs:
        w = WORD.findall(t or "")
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    n, links, root = len(docs), [0] * len(docs), list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(n), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    groups = collections.defaultdict(list)
    for k in range(n):
        groups[find(k)].append(k)
    want = collections.Counter()
    for members in groups.values():
        ids = [docs[k][0] for k in members if docs[k][0] is not None]
        for k in members:
            want[docs[k][0], min(ids) if ids else None, links[k]] += 1
    assert collections.Counter(tuple(r.values()) for r in rows_of(spark, messy_dir, "op8_bayes_jaccard")) == want
    assert max(links) >= 13


def test_blocks_find_what_pairs_find(spark, monkeypatch):
    """Large buckets and groups, dealt out in blocks, give the same classes and counts as listed pairs."""
    base = [f"w{k}" for k in range(100)]
    rows = [(i, " ".join(base[:i] + [f"e{i}"] + base[i + 1 :])) for i in range(60)] + [(100, " ".join(base)), (200, "something else " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    take = lambda: sorted((int(r["doc_id"]), int(r["class_id"]), r["n_links"]) for r in jaccard_bayes.near_duplicates(docs).collect())
    plain = take()
    monkeypatch.setattr(jaccard_bayes, "SMALL", 2)
    monkeypatch.setattr(jaccard_bayes, "BLOCK", 16)
    assert take() == plain
    assert {c for i, c, _ in plain if i <= 100} == {0} and max(x for *_, x in plain) == 60


def test_blocks_without_pairs(spark, monkeypatch):
    """A chain of single links in many blocks: most pairs of blocks have no pair that survives."""
    words = [f"w{k}" for k in range(800)]
    docs = spark.createDataFrame([(k, " ".join(words[10 * k : 10 * k + 100])) for k in range(60)], "doc_id long, text string")
    monkeypatch.setattr(jaccard_bayes, "SMALL", 2)
    monkeypatch.setattr(jaccard_bayes, "BLOCK", 4)
    got = sorted((int(r["doc_id"]), int(r["class_id"]), r["n_links"]) for r in jaccard_bayes.near_duplicates(docs).collect())
    assert got == [(k, 0, 1 if k in (0, 59) else 2) for k in range(60)]


def test_no_pairs_link_nothing():
    none = np.empty(0, np.int64)
    assert jaccard_bayes.linked([np.arange(3, dtype=np.uint64)], [], none, none, 0.8).tolist() == []


def test_fingerprints(spark, messy_dir, docs):
    got = rows_of(spark, messy_dir, "op9_lz_phrases")
    assert len(got) == len(docs)
    texts = texts_by_id(docs)
    ids = sorted({i for i, _ in docs if i is not None}, reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    checked = 0
    for i, after in zip(ids, ids[1:], strict=False):
        if i in texts and after in texts and i != 30:
            t, half = texts[i], len(texts[i]) // 2
            edited = t[: len(t) - half] + texts[after][:half]
            a, b, c = (lz_fingerprint.fingerprint(x) for x in (t, edited, texts[after]))
            r = by_id[i]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
            assert (r["fingerprint"], r["edited_fingerprint"]) == (lz_fingerprint.as_hex(a), lz_fingerprint.as_hex(b))
            assert r["near_edited"] == lz_fingerprint.likeness(a, b) and r["near_next"] == lz_fingerprint.likeness(a, c)
            checked += 1
    assert checked > 90


def test_buckets_do_not_change_fingerprints(spark, messy_dir):
    docs = spark.read.parquet(f"{messy_dir}/documents.parquet").where("doc_id is not null and doc_id <> 30").select("doc_id", "text")
    take = lambda n: sorted(tuple(r) for r in lz_fingerprint.compare_with_next(docs, bucket_rows=n).collect())
    assert take(7) == take(1000)


def test_phrases():
    ends, _ = lz_fingerprint.parse(b"abababab", {})
    assert ends == [1, 2, 4, 7]  # a, b, ab, aba, and b is left


def brute_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen = collections.Counter(windows)
    repeat = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(5)}
    lines = text.split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


@pytest.mark.parametrize("text", ["", "a b c d e a b c d e", "x x x x x x x", "a|b\n<p>\na|b\n\n \n \na|b", "1 2 3 4 5 6 1 2 3 4 5 9 2 3 4 5 6"])
def test_quality_counts(text):
    assert quality_mcd.text_counts(text)[:5] == brute_counts(text)


def test_quality_rules(spark, messy_dir, docs):
    got = rows_of(spark, messy_dir, "op10_robust_outliers")
    assert len(got) == len(docs)
    texts = texts_by_id(docs)
    for r in got:
        if r["doc_id"] in texts:
            want = brute_counts(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
            failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
            assert r["base_failed"] == failed and not (failed and r["kept"])


def test_robust_estimates_hold_against_labels(spark):
    base = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in rows_of(spark, base, "op10_robust_outliers")}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    judged = [(q, got[i]["kept"]) for i, q in labels.items() if i in got and not got[i]["base_failed"]]
    good, bad = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.3


def test_covariance_ignores_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [("en", "a", int(n), int(n * 5 + rng.normal(0, 8)), 0, 0, 0, 10, 5, 4) for n in rng.integers(100, 400, 600)]
    rows += [("en", "a", 200, 1000, 900, 0, 0, 10, 900, 4)] * 120
    stats = spark.createDataFrame(rows, "lang string, source string, " + quality_mcd.BASE)
    out = quality_mcd.judge(stats, quality_mcd.fit_outlier_model(stats)).groupBy("n_symbols").agg({"kept": "max", "far": "min"}).collect()
    kept = {r["n_symbols"]: r["max(kept)"] for r in out}
    assert kept == {0: True, 900: False}


@pytest.mark.parametrize("share", [0.3, 0.4])
@pytest.mark.parametrize("copies", [True, False])
def test_covariance_ignores_large_groups_of_outliers(spark, share, copies):
    """Copies of one bad row, or bad rows that all differ, are that share of a source."""
    rng = np.random.default_rng(7)
    n = int(600 * share / (1 - share))
    rows = [("en", "a", int(k), int(k * 5 + rng.normal(0, 8)), 0, 0, 0, 10, 5, 4) for k in rng.integers(100, 400, 600)]
    rows += [("en", "a", 200 + i * (not copies), 1000 + 5 * i * (not copies), 900, 0, 0, 10, 900, 4) for i in range(n)]
    stats = spark.createDataFrame(rows, "lang string, source string, " + quality_mcd.BASE)
    out = quality_mcd.judge(stats, quality_mcd.fit_outlier_model(stats)).collect()
    kept = {k: np.mean([r["kept"] for r in out if r["n_symbols"] == k]) for k in (0, 900)}
    assert kept[900] == 0 and kept[0] > 0.99


def brute_concentration(x: np.ndarray, start: np.ndarray) -> float:
    """Concentration steps over a matrix from a subset, till the log determinant of a full subset no longer falls."""
    floor = np.diag(np.square(list(quality_mcd.FEATURES.values())))
    size, chosen, least = math.ceil(len(x) * quality_mcd.H), start, np.inf
    while True:
        cov = np.cov(x[chosen].T, bias=True) * quality_mcd.consistency(quality_mcd.H) + floor
        now = np.linalg.slogdet(cov)[1]
        if len(chosen) == size and now > least - 1e-9:
            return least
        least = now if len(chosen) == size else np.inf
        diff = x - x[chosen].mean(0)
        chosen = np.argsort(np.einsum("ni,ij,nj->n", diff, np.linalg.inv(cov), diff), kind="stable")[:size]


@pytest.mark.parametrize("share", [0.0, 0.35])
def test_determinants_are_as_small_as_those_of_many_starts(spark, share):
    """Against starts drawn from the clean rows. Starts from any rows can end lower where a third of the rows is one
    tight cluster, in a subset that is mostly that cluster; the robust guesses keep clear of it."""
    rng = np.random.default_rng(12)
    mixed = rng.normal(size=(6, 6)) * 0.2
    x = rng.normal(size=(300, 6)) @ mixed
    x[: int(300 * share)] = x[: int(300 * share)] * 0.3 + rng.normal(size=6) * 4
    names = list(quality_mcd.FEATURES)
    stats = spark.createDataFrame([(0, "en", "a", *map(float, r)) for r in x] + [(0, None, None, *map(float, r)) for r in x[::2]], "level int, lang string, source string, " + ", ".join(f"{n} double" for n in names))
    got = {r["lang"]: r for r in quality_mcd.least_determinants(stats).collect()}
    assert set(got) == {"en", None}
    brute = [brute_concentration(x, rng.choice(np.arange(int(300 * share), 300), 12, replace=False)) for _ in range(60)]
    assert got["en"]["logdet"] <= min(brute) + 0.05
    # steps from the estimate found take hardly more off its determinant
    diff = x - np.array(got["en"]["mean"])
    far = np.einsum("ni,ij,nj->n", diff, np.array(got["en"]["inverse"]).reshape(6, 6), diff)
    assert brute_concentration(x, np.argsort(far, kind="stable")[:150]) >= got["en"]["logdet"] - 0.05


def test_many_groups_take_estimates_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(quality_mcd, "MANY", 2)
    rng = np.random.default_rng(3)
    rows = [("en", "abcd"[i % 4], int(n), int(n * 5 + rng.normal(0, 8)), 0, 0, 0, 10, 5, 4) for i, n in enumerate(rng.integers(100, 900, 1200))]
    rows += [("en", "a", 200, 1000, 900, 0, 0, 10, 900, 4)] * 120
    stats = spark.createDataFrame(rows, "lang string, source string, " + quality_mcd.BASE)
    shuffled = quality_mcd.judge(stats, quality_mcd.fit_outlier_model(stats)).select("n_words", "kept", "far").collect()
    monkeypatch.undo()
    broadcast = quality_mcd.judge(stats, quality_mcd.fit_outlier_model(stats)).select("n_words", "kept", "far").collect()
    assert sorted((r[0], r[1], round(r[2], 6)) for r in shuffled) == sorted((r[0], r[1], round(r[2], 6)) for r in broadcast)


def test_chi_square():
    assert quality_mcd.chi2_cdf(2.0, 2) == pytest.approx(1 - math.exp(-1))
    assert quality_mcd.chi2_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3)


def test_components_match_union_find(spark):
    rng = np.random.default_rng(5)
    chain, star = [(k, k + 1) for k in range(1000, 1012)], [(3000, 3000 + k) for k in range(1, 40)]
    edges = [tuple(x) for x in rng.integers(0, 300, (180, 2)).tolist()] + chain + star + star[:5] + [(7, 7), (5000, 5000)]
    names = {x: hashlib.md5(str(x).encode()).digest() for e in edges for x in e}
    root = {names[x]: names[x] for a, b in edges if a != b for x in (a, b)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in ((names[a], names[b]) for a, b in edges if a != b):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    made = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a binary, b binary")
    got = [(bytes(r["node"]), bytes(r["root"])) for r in jaccard_bayes.components(made).collect()]
    assert sorted(got) == sorted((x, find(x)) for x in root)
    assert jaccard_bayes.components(made.where("false")).collect() == []
