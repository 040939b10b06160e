"""The training-data operators against brute force, and their defined edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tokenloom.llm import (chat, components, embedding_dedup, minhash, mixing, packing, quality_classifier,
                           quality_rules, sharding, toxicity, url_filter)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, target string"


def sentence(rng, n, vocab=400):
    return " ".join("the" if rng.random() < 0.1 else f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty, blank, very long, repeated rows, equal and near-equal texts, a null source and id."""
    rng = random.Random(4)
    base = [sentence(rng, 60) for _ in range(25)]
    out = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    out += [(100 + i, base[0], "en", "s0", 1) for i in range(6)]
    out += [(200 + i, base[1] + f" extra{i}", "de", "s1", 1) for i in range(4)]
    out += [(300, None, None, None, None), (301, "", "en", "s2", 0), (302, " \n\t ", "en", None, 3),
            (303, "Three little words", "en", "s0", 5), (304, "THREE little words", "en", "s0", 5),
            (305, sentence(rng, 12000, 5000), "en", "s1", 9), (None, base[2], "en", "s2", 1)]
    out += [(400, "repeated row " * 8, "en", "s1", 2)] * 3
    return [(*r, "x", "y", "z") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(t):
    w = (t or "").encode().lower().split()
    return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(sets):
    """Least node reachable by similarity of at least 0.75; sets: {node: set}."""
    root = {n: n for n in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in sets}


def test_minhash_equals_brute_force(docs, rows):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    want = brute_components(sets)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (want[2], False)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_minhash_second_pass_links_what_the_least_id_does_not(spark):
    # chains of texts where neighbours are similar and ends are not, in one bucket with others
    rng = random.Random(8)
    words = [f"v{i}" for i in range(300)]
    texts, current = [], words[:120]
    for i in range(14):
        texts.append((i, " ".join(current)))
        current = current[6:] + [f"n{i}_{k}" for k in range(6)]
    rng.shuffle(texts)
    texts = [(i, t) for i, (_, t) in enumerate(texts)]
    want = brute_components({i: shingles(t) for i, t in texts})
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_minhash_estimate_loses_less_than_the_bands():
    from math import comb
    sig = np.arange(minhash.MINIMA, dtype=np.uint32)
    pair = lambda k: pa.RecordBatch.from_arrays(  # noqa: E731  k equal minima
        [pa.array([1]), pa.array([2]), pa.array([sig.tobytes()]), pa.array([np.where(sig < k, sig, sig + 1000).astype(np.uint32).tobytes()])],
        names=["a", "b", "sa", "sb"])
    kept = [next(minhash._agree([pair(k)])).num_rows for k in range(minhash.MINIMA + 1)]
    lost = sum(comb(128, k) * 0.75 ** k * 0.25 ** (128 - k) for k in range(kept.index(1)))
    assert kept == sorted(kept) and lost < 0.2 * (1 - 0.75 ** minhash.ROWS) ** minhash.BANDS


def test_dedup_keeps_one_row_per_group_and_all_columns(docs, rows):
    got = minhash.dedup(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    want = brute_components({r[0]: shingles(r[1]) for r in rows if r[0] is not None})
    assert sorted(ids) == sorted({v for v in want.values()})


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(5, 5)] + [(7, i) for i in range(500, 700)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.id: r.component for r in got} == {x: find(x) for x in linked} and len(got) == len(linked)


def test_embedding_links_reach_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((40, 24))
    vec = np.concatenate([centre, centre[:20] + 0.15 * rng.standard_normal((20, 24)),
                          centre[0] + 0.3 * rng.standard_normal((300, 24)), rng.standard_normal((900, 24))])
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vec)]
    data += [(5000 + i, data[3][1]) for i in range(4)]
    odd = [(6000, None), (6001, []), (6002, [0.0] * 24), (6003, [1.0, None] + [0.0] * 22), (6004, [float("nan")] * 24),
           (6005, [1.0, 2.0]), (6006, [float("inf")] + [0.0] * 23)]
    got = {r.vec_id: r for r in embedding_dedup.embedding_links(
        spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")).collect()}
    x = np.array([v for _, v in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    ids = [i for i, _ in data]
    found, total = sum(got[i].n_links for i in ids), int(link.sum())
    assert all(got[i].n_links <= n for i, n in zip(ids, link.sum(axis=1))) and found >= 0.99 * total
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)
    assert got[5003].component_id == got[3].component_id == 3 and not got[5003].kept


def test_embedding_links_of_a_hot_group_are_whole(spark, tmp_path):
    # 30,000 vectors, a third of them near copies of one whose cosines reach from below to above 0.9
    rng = np.random.default_rng(12)
    centre = rng.standard_normal(64)
    vec = np.concatenate([centre + 0.31 * rng.standard_normal((10_000, 64)), rng.standard_normal((20_000, 64))])
    vec = vec[rng.permutation(len(vec))]
    pq.write_table(pa.table({"vec_id": np.arange(len(vec)), "embedding": pa.array(list(vec), pa.list_(pa.float64()))}), f"{tmp_path}/e.parquet")
    got = embedding_dedup.embedding_links(spark.read.parquet(f"{tmp_path}/e.parquet")).toPandas().sort_values("vec_id")
    x = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    want = np.concatenate([(x[s:s + 2000] @ x.T >= 0.9).sum(axis=1) - 1 for s in range(0, len(x), 2000)])
    assert want.sum() > 10_000 * 4_000 and (got.n_links.to_numpy() == want).all()
    assert got[want > 0].component_id.nunique() == 1


def test_quality_rules_counts(docs, rows):
    def brute(t):
        t = t or ""
        w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in t).split(" ") if x]
        at = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i:i + 8]), []).append(i)
        covered = {p for s in at.values() if len(s) > 1 for i in s for p in range(i, i + 8)}
        lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)

    got = sorted((tuple(r) for r in quality_rules.quality_rules(docs).select(
        *quality_rules.COUNTS, "base_failed").collect()))
    want = sorted((*b, b[0] < 20 or 100 * b[4] > 30 * b[0]) for b in (brute(r[1]) for r in rows))
    assert got == want


def test_url_rules(spark):
    urls = ["http://example.org/en/1x", "https://a.EXAMPLE.org/es/2?q", "ftp://b.com/de/x#y", "x.com/de/", None, "http://com/fr/",
            "http://notexample.org/es/1", "http://a.org", "http://a.org/", "p://q://r/de/", "http://" + "a." * 3000 + "com/de/9",
            "http://b.com/de/x#y", "http://\n.org/\nz"]

    def brute(u):
        if u is None or "://" not in u:
            return "", "", None, "allow"
        rest = u.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fit = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        return host, path, best and best[1] + best[2], best[0] if best else "allow"

    df = spark.createDataFrame([(i, u, "q") for i, u in enumerate(urls)], "page_id long, url string, host string")
    want = {i: brute(u) for i, u in enumerate(urls)}
    for most in (url_filter.MAX_BROADCAST, 0):  # broadcast rules, salted join
        judged = url_filter.url_verdicts(df, max_broadcast=most)
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()} == want


def test_url_rules_from_a_table(spark):
    """Many rules against plain Python; repeated rows and rules, a null rule, clashing columns, a dot in a name."""
    hosts = ["org", "a.org", "b.a.org", "com", "x.com"]
    rules = [("block" if (i * j) % 3 else "allow", h, f"/{'ab' * j}{i}" if j else "/") for i in range(9) for j in range(4)
             for h in hosts] + [("block", "org", None)]
    table = spark.createDataFrame(rules + rules[:7], "verdict string, host string, path string")
    urls = [f"http://{s}{h}{p}{k}" for s in ("", "q.") for h in hosts for p in ("/", "/ab", "/abab", "/c") for k in range(5)] * 2
    columns = ["page_id", "url", "rule", "Verdict", "__h", "d.o", "prefix", "digest"]
    df = spark.createDataFrame([(i, u, "r", "v", 1, 2, 3, "x") for i, u in enumerate(urls)], columns)

    def brute(u):
        host, _, path = u[7:].partition("/")
        fit = [r for r in rules[:-1] if (host == r[1] or host.endswith("." + r[1])) and ("/" + path).startswith(r[2])]
        best = max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block", r[1] + r[2]), default=None)
        return (best[1] + best[2], best[0]) if best else (None, "allow")

    for most in (url_filter.MAX_BROADCAST, 0):
        judged = url_filter.url_verdicts(df, table, max_broadcast=most)
        assert judged.columns == ["page_id", "url", "__h", "d.o", "prefix", "digest", "host", "path", "rule", "verdict"]
        assert {r.page_id: (r.rule, r.verdict) for r in judged.collect()} == {i: brute(u) for i, u in enumerate(urls)}
    assert {r.verdict for r in url_filter.url_verdicts(df, table.limit(0)).collect()} == {"allow"}
    assert url_filter.url_verdicts(df.limit(0), table).count() == 0


def test_chat_round_trip_of_every_layout(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\s>[\\INST]", "<", "</s", "s>", "", None, "a\nb", "\\", "[", "/INST]"]
    rows = [(1, i, ["user", "assistant", None, "sys</s>"][i % 4], t) for i, t in enumerate(nasty)]
    flat = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    other = [
        chat.canonical_turns(spark.createDataFrame([(2, [("user", "q<s>"), ("assistant", "a")])],
                                                   "conv_id long, messages array<struct<role:string,content:string>>")),
        chat.canonical_turns(spark.createDataFrame([(3, [("human", "q"), ("gpt", None)], "u")],
                                                   "conv_id long, conversations array<struct<from:string,value:string>>, extra string")),
        chat.canonical_turns(spark.createDataFrame([(4, "do", None, "done")], "conv_id long, instruction string, input string, output string")),
        chat.canonical_turns(spark.createDataFrame([(5, "p", "c")], "conv_id long, prompt string, completion string"))]
    want = {1: [(r[2] or "", r[3] or "") for r in rows], 2: [("user", "q<s>"), ("assistant", "a")],
            3: [("user", "q"), ("assistant", "")], 4: [("user", "do"), ("assistant", "done")], 5: [("user", "p"), ("assistant", "c")]}
    turns = flat
    for o in other:
        turns = turns.unionByName(o)
    out = chat.format_turns(turns).select("conv_id", chat.parse_formatted(chat.F.col("formatted")).alias("turns"),
                                          chat.loss_text(chat.F.col("pieces")).alias("loss"))
    for r in out.collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, something string"))


def test_mixing_targets_and_copies(docs, rows, none):
    size = [len((r[1] or "").split()) for r in rows]
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == sorted(size)
    by = {}
    for r in got:
        s = by.setdefault(r.source, [0, r.target, r.source_size, 0])
        s[0] += r.copies * r["size"]
        s[3] = max(s[3], r["size"])
        assert 0 <= r.copies <= 2
    for taken, target, total, largest in by.values():
        assert target <= 2 * total + 1e-6 and abs(taken - target) <= max(largest / 2, 24) + 1e-6
    assert sum(s[1] for s in by.values()) == pytest.approx(min(1.5 * sum(size), 2 * sum(size)))
    assert sorted((r.doc_id or -1, r.copies) for r in got) == sorted((r.doc_id or -1, r.copies) for r in mixing.mix(docs).collect())
    assert mixing.mix(none).count() == 0


def test_mixing_weights_are_unequal_probabilities(spark):
    df = spark.createDataFrame([(i, "one two three four", "s", 3.0 if i % 2 else 1.0) for i in range(2000)],
                               "doc_id long, text string, source string, w double")
    got = mixing.mix(df, targets=lambda sizes: {"s": 4000.0}, weight="w").toPandas()
    taken = got.assign(t=got.copies * got["size"]).groupby("w").t.sum()
    assert taken.sum() == pytest.approx(4000, abs=8) and taken[3.0] / taken[1.0] == pytest.approx(3, rel=0.15)


def test_mixing_prefers_longer_documents(spark, none):
    size = [1, mixing.LONG - 1, mixing.LONG, mixing.LONGER - 1, mixing.LONGER, 5 * mixing.LONGER, 0]
    df = spark.createDataFrame([(i, "w " * size[i % 7] if i % 7 < 6 else None, "s") for i in range(4200)],
                               "doc_id long, text string, source string")
    odds = mixing.length_odds(mixing.F.col("text"))
    whole = 600 * sum(size)
    got = mixing.mix(df, targets=lambda sizes: {"s": 0.3 * whole}, weight=odds).toPandas()
    assert (got.copies * got["size"]).sum() == pytest.approx(0.3 * whole, abs=5 * mixing.LONGER)
    mean = got[got["size"] > 0].groupby("size").copies.mean()
    by = [mean[[1, mixing.LONG - 1]].mean(), mean[[mixing.LONG, mixing.LONGER - 1]].mean(), mean[[mixing.LONGER, 5 * mixing.LONGER]].mean()]
    assert by[1] / by[0] == pytest.approx(2, rel=0.35) and by[2] / by[0] == pytest.approx(3, rel=0.35)
    full = mixing.mix(df, targets=lambda sizes: {"s": 2.0 * whole}, weight=odds).toPandas()
    assert set(full[full["size"] > 0].copies) == {2}
    assert mixing.mix(none, weight=odds).count() == 0


def test_sharding_bytes_and_slots(docs, rows, none):
    got = sharding.shard_documents(docs, shards=4, ranges=6).collect()
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda c: -1 if c is None else c
    assert sorted((crc(r.doc_id), r["size"], crc(r.text_crc32)) for r in got) == sorted(
        (crc(r[0]), size(r[1]), -1 if r[1] is None else zlib.crc32(r[1].encode())) for r in rows)
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    assert sharding.shard_documents(none).count() == 0


def test_sharding_splits_a_hot_text_only_when_it_must(spark):
    hot = [(i, "the same text again and again", "x") for i in range(900)]
    cold = [(1000 + i, f"text number {i} " * (1 + i % 7), "x") for i in range(1200)]
    df = spark.createDataFrame(hot + cold, "doc_id long, text string, shard string").repartition(6)
    got = sharding.shard_documents(df, shards=4, ranges=8).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 4 and (sums.max() - sums.min()) / sums.mean() < 0.05
    assert (got[got.doc_id >= 1000].groupby("text").shard.nunique() == 1).all()


@pytest.mark.parametrize("ranges", [5, 40])  # fewer and more than shuffle partitions
def test_packing_round_trip(docs, rows, none, ranges):
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = sorted(tuple(t.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows)
    got = packing.pack(docs, length=256, ranges=ranges).toPandas()
    seqs = got.sort_values(["sequence_id", "offset"])
    assert (seqs.groupby("sequence_id").length.cumsum() - seqs.length == seqs.offset).all()
    assert (seqs.groupby("sequence_id").length.sum().iloc[:-1] == 256).all()
    assert all(zlib.crc32(i) == c for i, c in zip(got.ids, got.ids_crc32))
    stream = np.frombuffer(b"".join(seqs.ids), dtype="<u4").tolist()
    back, doc = [], []
    for i in stream:
        doc.append(i)
        if i == 1:
            back.append(tuple(doc))
            doc = []
    assert sorted(back) == want
    assert packing.pack(none).count() == 0


def test_word_ids_equal_whole_texts():
    memo = packing.load_tokenizer()
    rng = random.Random(3)
    bits = ["a", "B", "é", "É", "'s", "'", "<|endoftext|>", "1", " ", "\n", ".", "!?", "ß", "İ", "Ç", "×", "Ÿ", "ς", "中", "\x85", "́", "x)", "😀"]
    for _ in range(3000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert packing.token_ids(s.encode(), memo).tolist() == memo.tokenizer.encode(s, add_special_tokens=False).ids + [1]


def test_added_strings_have_the_ids_of_the_unaltered_tokenizer():
    from tokenizers import Tokenizer
    import public_tokenizers
    plain, memo = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), packing.load_tokenizer()
    assert plain.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    rng = random.Random(5)
    bits = ["a", "B", "É", "'s", " ", "\n", ".", "́", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|<|endoftext|>|>"]
    for _ in range(3000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert packing.token_ids(s.encode(), memo).tolist() == plain.encode(s, add_special_tokens=False).ids + [1], s


def test_hilbert_neighbours_touch():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert(cells, bits=3)
    path = cells[np.argsort(key)]
    assert sorted(key) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_toxicity_held_out_accuracy(spark):
    rng = random.Random(6)
    bad = ["snarkle", "vompous", "grubbish"]
    rows, labels = [], []
    for i in range(900):
        w = sentence(rng, 80, 3000).split()
        y = int(i % 4 == 0)
        for _ in range(4 * y):
            w[rng.randrange(80)] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    rows += [(10_000, None), (10_001, ""), (None, "snarkle " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.Model.fit(toxicity.labelled_rows(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    test = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in test])
    assert right > 0.95 and all(0 <= s <= 1 for s in got.values()) and len(got) == len(rows)
    assert toxicity.Model.fit([]) is None and toxicity.score_toxicity(docs, None).filter("score = 0").count() == len(rows)


def test_co_training_learns_from_both_views(spark, docs, none):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(800):
        good = i % 5 != 0
        t = sentence(rng, 60) if good else " ".join(w.upper() + "!!" for w in sentence(rng, 60).split())
        rows.append((i, t, "en", "s1" if good else "s2", len(t)))
        labels.append((i, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = quality_classifier.fit(df, spark.createDataFrame(labels[:400], "doc_id long, quality int"))
    got = quality_classifier.score_quality(df, model).filter("doc_id >= 400").toPandas()
    assert ((got.doc_id % 5 != 0) == got.kept).mean() > 0.97 and ((got.doc_id % 5 != 0) == (got.meta_score > 0.5)).mean() > 0.9
    assert quality_classifier.score_quality(docs, model).count() == docs.count()
    assert quality_classifier.score_quality(none, model).count() == 0
    empty = quality_classifier.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert empty is None and quality_classifier.score_quality(docs, None).filter("kept").count() == docs.count()


@pytest.mark.parametrize("make", [
    lambda d: minhash.near_duplicates(d), lambda d: minhash.dedup(d), lambda d: quality_rules.quality_rules(d),
    lambda d: toxicity.score_toxicity(d, toxicity.Model(b"a", b"b", 0.0, np.zeros(5)))])
def test_empty_tables(none, make):
    assert make(none).count() == 0


def test_empty_vectors(spark):
    assert embedding_dedup.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stages_keep_columns_and_agree_with_brute_force(spark, docs, tmp_path):
    import corpus_pipeline as p
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in p.STAGES] == ["quality classifier", "quality rules", "MinHash near-dedup", "mixing sources", "packing"]
    at = docs
    for name, stage in p.STAGES[:4]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns, name
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    last = p.run(spark, str(tmp_path)).collect()
    mixed = at.collect()
    assert mixed and {r.doc_id for r in last} == {r.doc_id for r in mixed}
    assert sum(1 for r in last if r.start == 0) == len(mixed)


def test_pipeline_stages_reject_and_repeat_the_right_documents(spark, tmp_path):
    import corpus_pipeline as p
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(600):  # good and bad ones, then short ones, repeating ones and near copies of good ones
        good = i % 5 != 0
        t = sentence(rng, 60) if good else " ".join(w.upper() + "!!" for w in sentence(rng, 60).split())
        rows.append((i, t, "en", f"s{i % 2}" if good else "s2", len(t), "x", "y", "z"))
        labels.append((i, int(good), 0))
    extra = [(1000 + i, sentence(rng, 12)) for i in range(10)] + [(1100 + i, sentence(rng, 10) + " a b c d e f g h" * 6) for i in range(10)]
    extra += [(1200 + i, rows[5 * i + 1][1] + f" tail{i}") for i in range(40)]
    rows += [(i, t, "en", f"s{i % 2}", len(t), "x", "y", "z") for i, t in extra]
    spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.createDataFrame(rows, SCHEMA)
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    ids = []
    for _, stage in p.STAGES[:4]:
        at = stage(spark, at, str(tmp_path))
        ids.append(sorted(r.doc_id for r in at.select("doc_id").collect()))
    first, ruled, single, mixed = ids
    bad = {i for i in range(600) if i % 5 == 0}
    assert len(bad & set(first)) <= 0.03 * len(bad) and len(set(range(600)) - bad - set(first)) <= 0.03 * 480

    def breaks(t):
        w = t.split()
        seen = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i:i + 8]), []).append(i)
        covered = {k for s in seen.values() if len(s) > 1 for i in s for k in range(i, i + 8)}
        return (len(w) < 20 or 100 * len(covered) > 30 * len(w) or t.count("!") > 0.5 * len(w)
                or sum(x in ("the", "a") for x in w) < 0.01 * len(w))

    assert ruled == [i for i in first if not breaks(text[i])] and len(ruled) < len(first)
    comp = brute_components({i: shingles(text[i]) for i in ruled})
    assert single == sorted(set(comp.values())) and len(single) < len(ruled)
    words = {i: len(text[i].split()) for i in single}
    names = sorted({source[i] for i in single})
    size = {s: sum(n for i, n in words.items() if source[i] == s) for s in names}
    want, rest, open_ = {}, 1.5 * sum(size.values()), dict(zip(names, (5, 2, 1)))
    while over := [s for s in open_ if rest * open_[s] / sum(open_.values()) > 2 * size[s]]:
        total = sum(open_.values())
        over = [s for s in over if rest * open_[s] / total > 2 * size[s]]
        want |= {s: 2 * size[s] for s in over}
        rest -= sum(2 * size[s] for s in over)
        open_ = {s: w for s, w in open_.items() if s not in over}
    want |= {s: rest * w / sum(open_.values()) for s, w in open_.items()}
    copies = {i: mixed.count(i) for i in single}
    assert set(mixed) <= set(single) and max(copies.values()) == 2
    for s in names:
        assert abs(sum(copies[i] * words[i] for i in single if source[i] == s) - want[s]) <= max(words.values()) / 2 + 1e-6


def test_chat_digest_matches_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "hé"), (1, 1, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    out = chat.format_turns(chat.canonical_turns(df)).select(chat.F.sha2(chat.loss_text(chat.F.col("pieces")), 256).alias("h")).first()
    assert out.h == hashlib.sha256(b"ok").hexdigest()


def test_toxic_texts_of_any_length_are_learnt(spark):
    """Very long labelled texts are not left out of the fit; null ones hold nothing to learn."""
    rng = random.Random(3)
    rows = [(i, ("hateful slurword " if i % 2 else "kindly garden ") * 3 + sentence(rng, 30)) for i in range(200)]
    rows = [(i, t + (" " + t) * 400 if i % 2 else t) for i, t in rows] + [(900, None)]
    assert min(len(t) for i, t in rows if i % 2) > toxicity.MAX_CHARS
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.labelled_rows(docs, labels)
    fold = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5}
    assert sum(y for _, y, _ in got) == sum(i % 2 for i in fold)
    assert all("slurword" in t for t, y, _ in got if y)


def test_chat_with_columns_of_other_layouts(spark):
    """prompt, system and the like beside role, text and turn change nothing."""
    plain = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (None, 0, None, None)],
                                  "conv_id long, turn long, role string, text string")
    clash = plain.selectExpr("*", "'p' AS prompt", "'s' AS system", "'r' AS response", "'i' AS instruction")
    want = sorted(map(str, chat.canonical_turns(plain).collect()))
    assert sorted(map(str, chat.canonical_turns(clash).collect())) == want
    assert chat.canonical_turns(plain.limit(0)).collect() == []


def test_mix_with_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * 3, f"s{i % 2}", "x", "y") for i in range(40)],
                                 "doc_id long, text string, source string, __w string, __p string")
    mixed = mixing.mix(docs)
    plain = mixing.mix(docs.select("doc_id", "text", "source"))
    columns = ["doc_id", "size", "source_size", "target", "copies"]
    assert sorted(map(tuple, mixed.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    assert {"__w", "__p"} <= set(mixing.repeat_copies(mixed, docs.columns).columns)


def test_punctuated_words_take_no_room_among_remembered_ones():
    """A word is remembered once, not once for every mark after it; the ids stay those of whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(packing.TOKENIZER)
    memo, whole = packing.WordIds(Tokenizer.from_file(path)), Tokenizer.from_file(path)
    text = "Alpha, alpha; alpha. alpha!? Beta) café, café. 12, a, ÷, ×. 你, it's, ... x|y| (alpha) É. ß;"
    ids = packing.token_ids(text.encode(), memo).tolist()
    assert ids == [*whole.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert {b"alpha", "café".encode(), b",", b"."} <= set(memo)
    assert not {b"alpha,", b"alpha;", b"alpha.", b"alpha!?", b"beta)", "café,".encode()} & set(memo)


def test_many_texts_are_tokenised_at_once(monkeypatch):
    """The ids are those of whole texts, with few words remembered; new words of letters reach the model in one call."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = public_tokenizers.path(packing.TOKENIZER)
    whole = Tokenizer.from_file(path)
    rng = random.Random(9)
    bits = ["a", "B", "é", "É", "'s", "'", "<|endoftext|>", "1", " ", "  ", "\n", "\x0b", ".", "!?", ",*", "|", "ß", "İ", "Ç", "×", "÷", "Ÿ",
            "ς", "中", "\x85", "\xa0", "\u2003", "́", "x)", "😀", "</w>", "Wort", "q, ", "7. "]
    texts = [None, "", " ", "x " * 3000, " a", "a\x00b c."] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    want = [[*whole.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
    column = pa.array([t if t is None else t.encode() for t in texts], pa.binary())
    for most, size in ((1 << 15, 1 << 21), (50, 1000)):
        monkeypatch.setattr(packing, "MEMO", most)
        monkeypatch.setattr(packing, "TEXT_BYTES", size)
        memo = packing.WordIds(Tokenizer.from_file(path))
        got = packing.all_token_ids(column, memo)
        assert [g.tolist() for g in got] == want and {g.dtype for g in got} == {np.dtype("uint32")}
        assert len(memo) <= most and len(memo.old) <= most
        assert [g.tolist() for g in packing.all_token_ids(column.slice(5, 100), memo)] == want[5:105]
    assert packing.all_token_ids(column.slice(0, 0), memo) == []

    class Calls:
        def __init__(self, to):
            self.to, self.n = to, 0

        def __getattr__(self, name):
            self.n += 1
            return getattr(self.to, name)

    memo = packing.WordIds(Tokenizer.from_file(path))
    memo.model, memo.tokenizer, memo.letters = Calls(memo.model), Calls(memo.tokenizer), Calls(memo.letters)
    column = pa.array([f"Word{chr(97 + i)} again, wörd{chr(97 + i)}".encode() for i in range(26)] * 2, pa.binary())
    assert [g.tolist() for g in packing.all_token_ids(column, memo)] == [
        [*whole.encode(t.decode(), add_special_tokens=False).ids, packing.END_ID] for t in column.to_pylist()]
    assert (memo.letters.n, memo.tokenizer.n) == (1, 1) and memo.model.n == 0  # the comma is not of letters


def test_models_that_do_not_mark_word_ends_are_asked_word_by_word():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    memo = packing.WordIds(Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)))
    memo.last = np.zeros_like(memo.last)
    texts = ["anew wörds, 12 anew", "other"]
    want = [[*memo.tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    assert [g.tolist() for g in packing.all_token_ids(pa.array([t.encode() for t in texts], pa.binary()), memo)] == want


def test_words_of_letters_are_looked_up_as_columns(monkeypatch):
    """None becomes an object that is remembered by itself; those kept as columns are few, short and used again."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = public_tokenizers.path(packing.TOKENIZER)
    whole = Tokenizer.from_file(path)
    rng = random.Random(11)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    pool = letters + ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(300)] + ["Long" * 40, "á" * 33]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    column = pa.array([t.encode() for t in texts], pa.binary())
    want = [[*whole.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    for most, size, at_once in ((20, 3000, 7), (1 << 15, 1 << 21, 1 << 13)):
        monkeypatch.setattr(packing, "MEMO", most)
        monkeypatch.setattr(packing, "TEXT_BYTES", size)
        monkeypatch.setattr(packing, "AT_ONCE", at_once)
        memo = packing.WordIds(Tokenizer.from_file(path))
        assert [g.tolist() for g in packing.all_token_ids(column, memo)] == want
        assert not memo and not memo.old
        seen = memo.seen.to_pylist()
        assert 0 < len(seen) == len(set(seen)) <= 2 * most and max(len(w.encode()) for w in seen) <= packing.SEEN_BYTES
        assert len(memo.seen_ids) == memo.seen_sizes.sum() and len(memo.seen_uses) == len(seen)
        memo.spelling = None  # as with a model that doesn't see bytes
        memo.seen, memo.seen_ids, memo.seen_sizes, memo.seen_uses = (x[:0] for x in (memo.seen, memo.seen_ids, memo.seen_sizes, memo.seen_uses))
        assert [g.tolist() for g in packing.all_token_ids(column, memo)] == want
    once = pa.array([" ".join(letters).encode()], pa.binary())
    memo = packing.WordIds(Tokenizer.from_file(path))
    first = packing.all_token_ids(once, memo)[0].tolist()
    memo.letters = None  # not asked again
    assert packing.all_token_ids(once, memo)[0].tolist() == first


def test_runs_are_even_and_bounded(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(packing, "TEXT_BYTES", 1000)
    for sizes in ([100] * 25, [0] * 9, [5000, 1, 1], [], [None, 3, None], [1] * 2500):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64()), pa.array(
            [None if n is None else b"x" * n for n in sizes], pa.binary())], names=["doc_id", "t"])
        runs = list(packing.in_runs([batch], 1))
        assert [i for r in runs for i in r.column(0).to_pylist()] == list(range(len(sizes)))
        assert all(r.num_rows and sum(len(t or b"") for t in r.column(1).to_pylist()[:-1]) <= 1000 for r in runs)
    assert [r.num_rows for r in runs] == [834, 833, 833]


def test_packing_hands_python_small_batches(spark, tmp_path, monkeypatch):
    seen, keyer = str(tmp_path), packing._keyer

    def noting(*args):
        inner = keyer(*args)

        def run(batches):
            def noted():
                for b in batches:
                    with open(f"{seen}/sizes", "a") as f:
                        f.write(f"{b.nbytes}\n")
                    yield b
            return inner(noted())
        return run

    monkeypatch.setattr(packing, "_keyer", noting)
    monkeypatch.setattr(packing, "BATCH", "64k")
    docs = spark.range(600, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('word', id % 7, ' '), 300) AS text")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert spark.conf.get(key, None) is None
    got = packing.pack(docs, with_ids=False)
    assert spark.conf.get(key, None) is None
    sizes = list(map(int, open(f"{seen}/sizes").read().split()))
    assert sum(sizes) > 600 * 1800 and max(sizes) < 100_000  # one batch before
    assert got.select("doc_id").distinct().count() == 600


def test_batches_of_leaves_the_sessions_own_size(spark):
    from tokenloom.llm.common import batches_of
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "1m")
    try:
        before = spark.conf.get(key)
        with batches_of(spark, "4m"):
            assert spark.conf.get(key) == before
        assert spark.conf.get(key) == before
    finally:
        spark.conf.unset(key)
    with pytest.raises(KeyError), batches_of(spark, "4m"):
        raise KeyError
    assert spark.conf.get(key, None) is None


def test_released_gives_freed_memory_back():
    from tokenloom.llm.common import released

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    batch, own = pa.RecordBatch.from_pydict({"a": [1, 2]}), pa.default_memory_pool().backend_name
    held = [b"x" * 5000 for _ in range(20_000)]
    held = held[-1]  # 100 MB are freed below what is still in use
    before = resident()
    assert list(released(iter([batch, batch]))) == [batch, batch]
    assert before - resident() > 50e6
    assert pa.default_memory_pool().backend_name == own and len(held) == 5000
