from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from tokenloom.operators import bpe
from tokenloom.sources.files import load_tokenizer, save_tokenizer

from conftest import py_regex

TEXTS = [
    "the cat sat on the mat. the cat's hat!",
    "  leading spaces and\n\ntwo newlines\tand tab   ",
    "numbers 123 4567 and émoji 😀😀 done",
    "it's they're we've I'm you'll he'd",
    "the the the then there their",
    "",
    "x",
]
PY_PAT = regex.compile(py_regex(bpe.PRETOKEN_PATTERN))
GPT2 = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")


def test_pattern_matches_published_gpt2_on_common_whitespace():
    for t in TEXTS:
        assert PY_PAT.findall(t) == GPT2.findall(t)


def test_pretokens_equal_python(spark):
    got = {r.doc_id: r.w for r in docs(spark).select("doc_id", bpe.pretokens("text").alias("w")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == PY_PAT.findall(t)


def naive_train(texts, n_merges, min_freq=2):
    words = Counter(w for t in texts for w in PY_PAT.findall(t))
    seqs = {w: list(w.encode()) for w in words}
    merges = []
    for k in range(n_merges):
        pc = Counter()
        for w, s in seqs.items():
            for a, b in zip(s, s[1:]):
                pc[(a, b)] += words[w]
        cands = [(-n, a, b) for (a, b), n in pc.items() if n >= min_freq]
        if not cands:
            break
        n, a, b = min(cands)
        new = 256 + k
        merges.append((a, b, new, -n))
        for w, s in seqs.items():
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == a and s[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            seqs[w] = out
    return merges


def naive_encode(text, merges):
    ids = []
    for w in PY_PAT.findall(text):
        s = list(w.encode())
        for a, b, new, _ in merges:
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == a and s[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            s = out
        ids.extend(s)
    return ids


@pytest.fixture(scope="module")
def model(spark):
    counts = bpe.pretoken_counts(docs(spark))
    return bpe.train_bpe(spark, counts, 256 + 12 + 1, batch=5)


def test_train_equals_naive_bpe(spark, model):
    got = [(r.l, r.r, r.id, r.freq) for r in model.merges.orderBy("rank").collect()]
    assert got == naive_train(TEXTS, 12)


def test_pair_counts_and_top_pair(spark):
    words = bpe.words_table(bpe.pretoken_counts(docs(spark)))
    pc = {(r.l, r.r): r.n for r in bpe.pair_counts(words).collect()}
    wc = Counter(w for t in TEXTS for w in PY_PAT.findall(t))
    want = Counter()
    for w, n in wc.items():
        b = w.encode()
        for x, y in zip(b, b[1:]):
            want[(x, y)] += n
    assert pc == {k: v for k, v in want.items() if v >= 2}
    top = bpe.top_pair(bpe.pair_counts(words)).first()
    assert (top.n, -top.l, -top.r) == max((n, -a, -b) for (a, b), n in pc.items())


def test_encode_equals_naive_and_round_trips(spark, model):
    merges = bpe.merges_list(model)
    enc = bpe.encode_documents(docs(spark), merges)
    naive_m = [(l, r, n, 0) for l, r, n in merges]
    got = {r.doc_id: r.ids for r in enc.collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == naive_encode(t, naive_m)
    dec = {r.doc_id: r.text for r in bpe.decode_ids(enc, model.vocab).collect()}
    assert dec == dict(enumerate(TEXTS))


def test_vocab_layout_and_specials(model):
    v = {r.id: (bytes(r.token), r.special) for r in model.vocab.collect()}
    assert all(v[i] == (bytes([i]), False) for i in range(256))
    assert v[256 + 12] == (b"<|endoftext|>", True)
    m = {r.id: (r.l, r.r) for r in model.merges.collect()}
    for i, (l, r) in m.items():
        assert v[i][0] == v[l][0] + v[r][0]


def test_token_to_id(spark, model):
    t = spark.createDataFrame([(bytearray(b"<|endoftext|>"),), (bytearray(b"a"),)], "token BINARY")
    got = {bytes(r.token): r.id for r in bpe.token_to_id(t, model.vocab).collect()}
    assert got == {b"<|endoftext|>": 268, b"a": 97}


def test_tokenizer_tables_round_trip(spark, model, tmp_path):
    save_tokenizer(model, str(tmp_path / "tok"))
    m2 = load_tokenizer(spark, str(tmp_path / "tok"))
    assert sorted(m2.merges.collect()) == sorted(model.merges.collect())
    assert sorted(m2.vocab.collect()) == sorted(model.vocab.collect())


def test_no_pair_left_stops_early(spark):
    counts = bpe.pretoken_counts(docs(spark, ["ab", "cd"]))
    m = bpe.train_bpe(spark, counts, 256 + 10 + 1)
    assert m.merges.count() == 0
    assert {r.id for r in m.vocab.filter("special").collect()} == {256}


def test_decode_specials_and_cut_characters(spark, model):
    seqs = spark.createDataFrame([(1, [104, 105, 268]), (2, [195]), (3, [])], "doc_id BIGINT, ids ARRAY<INT>")
    got = {r.doc_id: r.text for r in bpe.decode_ids(seqs, model.vocab).collect()}
    assert got == {1: "hi", 2: "�", 3: ""}
    shown = {r.doc_id: r.text for r in bpe.decode_ids(seqs, model.vocab, skip_special=False).collect()}
    assert shown == {1: "hi<|endoftext|>", 2: "�", 3: ""}
    unknown = spark.createDataFrame([(1, [104, 9999, 105])], "doc_id BIGINT, ids ARRAY<INT>")
    assert bpe.decode_ids(unknown, model.vocab).first().text == "hi"


def test_special_tokens_are_one_id(spark, model):
    df = docs(spark, ["hello<|endoftext|>", "<|endoftext|><|endoftext|>a <|endoftext|> b", "<|endoftext|", ""])
    merges = bpe.merges_list(model)
    got = {r.doc_id: r.ids for r in bpe.encode_documents(df, merges, specials={"<|endoftext|>": 268}).collect()}
    part = lambda t: naive_encode(t, [(l, r, n, 0) for l, r, n in merges])
    assert got == {0: part("hello") + [268], 1: [268, 268] + part("a ") + [268] + part(" b"),
                   2: part("<|endoftext|"), 3: []}


def test_lowest_rank_first_on_random_words():
    """merge_word against a loop that looks for the earliest merge anywhere in the word, step by step."""
    import random
    rnd = random.Random(3)
    for _ in range(200):
        ids, merges = [97, 98, 99], {}
        for k in range(12):
            merges.setdefault((rnd.choice(ids), rnd.choice(ids)), 256 + k)
            ids.append(256 + k)
        word = [rnd.choice([97, 98, 99]) for _ in range(rnd.randint(0, 14))]
        s = list(word)
        while True:
            found = [(merges[p], i) for i, p in enumerate(zip(s, s[1:])) if p in merges]
            if not found:
                break
            new, i = min(found)
            s[i:i + 2] = [new]
        assert bpe.merge_word(list(word), merges) == s


def test_token_to_id_keeps_unknown_tokens(spark, model):
    t = spark.createDataFrame([(bytearray(b"no such token"),)], "token BINARY")
    assert [r.id for r in bpe.token_to_id(t, model.vocab).collect()] == [None]


def test_many_merges_in_few_jobs_equal_naive(spark):
    import random
    rnd = random.Random(21)
    texts = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 6))) for _ in range(40))
             for _ in range(12)]
    for batch, head_words in ((1024, 1 << 17), (64, 5), (3, 0)):
        m = bpe.train_bpe(spark, bpe.pretoken_counts(docs(spark, texts)), 256 + 40 + 1,
                          batch=batch, head_words=head_words)
        got = [(r.l, r.r, r.id, r.freq) for r in m.merges.orderBy("rank").collect()]
        assert got == naive_train(texts, 40)


def test_long_merge_lists(spark):
    import random
    rnd = random.Random(5)
    ids = list(range(97, 101))               # bytes of 'abcd'
    merges = []
    for k in range(300):                     # a long list
        l, r = rnd.choice(ids), rnd.choice(ids)
        merges.append((l, r, 256 + k))
        ids.append(256 + k)
    texts = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 60))) for _ in range(20)]
    naive = [(l, r, n, 0) for l, r, n in merges]
    docs_df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.ids for r in bpe.encode_documents(docs_df, merges).collect()}
    for i, t in enumerate(texts):
        assert got[i] == naive_encode(t, naive)
    tokens = {i: bytes([i]) for i in range(256)}
    for l, r, n in merges:
        tokens[n] = tokens[l] + tokens[r]
    vocab = spark.createDataFrame([(i, bytearray(b), False) for i, b in tokens.items()],
                                  "id INT, token BINARY, special BOOLEAN")
    enc = bpe.encode_documents(docs_df, merges)
    assert {r.doc_id: r.text for r in bpe.decode_ids(enc, vocab).collect()} == dict(enumerate(texts))


def test_train_random_corpora_equal_naive(spark):
    import random
    rnd = random.Random(9)
    for trial in range(3):
        texts = [" ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5)))
                          for _ in range(rnd.randint(1, 8))) for _ in range(rnd.randint(2, 6))]
        m = bpe.train_bpe(spark, bpe.pretoken_counts(docs(spark, texts)), 256 + 8 + 1, batch=3, head_words=7)
        got = [(r.l, r.r, r.id, r.freq) for r in m.merges.orderBy("rank").collect()]
        assert got == naive_train(texts, 8), (trial, texts)


def test_pretokens_random_strings_equal_python(spark):
    import random
    rnd = random.Random(13)
    alphabet = list("ab Z9'sdtlmrve.,!?-") + ["'s", "'ll", " ", "  ", "\n", "\t", "\xa0", " ",
                                               "\x1c", "é", "ß", "\U0001F600", "٣"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.w for r in df.select("doc_id", bpe.pretokens("text").alias("w")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == PY_PAT.findall(t), t


def test_every_character_survives_encoding_with_specials(spark, model):
    """Random Unicode, the highest BMP characters and U+FFFF among it, with and without special tokens."""
    import random
    rnd = random.Random(77)
    pool = ["￿", "￾", "﻿", "\U0010ffff", "\U0001F600", " ", "\u0000", "\n", " ", "a", "<", "|", "endoftext",
            bpe.END_OF_TEXT, "é", "中"]
    texts = ["a ￿ b", "", bpe.END_OF_TEXT] + ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    texts += ["x" * 200_000 + bpe.END_OF_TEXT + "y" * 200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    specials = {bpe.END_OF_TEXT: 300}
    merges = bpe.merges_list(model)
    with_specials = bpe.encode_documents(df, merges, specials=specials)
    vocab = model.vocab.filter("not special").unionByName(
        spark.createDataFrame([(300, bytearray(bpe.END_OF_TEXT.encode()), True)], "id INT, token BINARY, special BOOLEAN"))
    back = {r.doc_id: r.text for r in bpe.decode_ids(with_specials, vocab, skip_special=False).collect()}
    assert back == dict(enumerate(texts))
    plain = {r.doc_id: r.ids for r in bpe.encode_documents(df, merges).collect()}
    special = {r.doc_id: r.ids for r in with_specials.collect()}
    for i, t in enumerate(texts):
        if bpe.END_OF_TEXT not in t:
            assert plain[i] == special[i]


def test_long_word_in_n_log_n():
    """A word of a million letters takes seconds; on short words the same code equals the plain loop."""
    import random
    import time
    rnd = random.Random(3)
    ranks, ids = {}, list(range(97, 101))
    for k in range(400):
        ranks.setdefault((rnd.choice(ids), rnd.choice(ids)), 256 + k)
        ids.append(256 + k)
    word = [97 + rnd.randrange(4) for _ in range(1_000_000)]
    began = time.time()
    merged = bpe.merge_word(word, ranks)
    assert time.time() - began < 60 and len(merged) < len(word)
    parts = {new: pair for pair, new in ranks.items()}

    def spelt(t):
        return [t] if t < 256 else spelt(parts[t][0]) + spelt(parts[t][1])

    assert [b for t in merged for b in spelt(t)] == word


def test_changes_of_a_merge_are_those_of_a_recount():
    import random
    from collections import Counter
    rnd = random.Random(12)
    for _ in range(300):
        word = [97 + rnd.randrange(2) for _ in range(rnd.randint(0, 14))]
        pair = (97 + rnd.randrange(2), 97 + rnd.randrange(2))
        changes = Counter()
        merged = bpe.merge_word(word, {pair: 256}, lambda step, p, by: changes.update({p: by}))
        want = Counter(zip(merged, merged[1:]))
        want.subtract(Counter(zip(word, word[1:])))
        assert {p: n for p, n in changes.items() if n} == {p: n for p, n in want.items() if n}


def test_queries_with_few_merges_equal_sql(spark, monkeypatch):
    """The tokenizer queries against DuckDB, which unrolls 16 merges (the registered tokenizer has more)."""
    import duckdb
    from tokenloom.plans import fixtures as fx, oracle, queries as Q
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(fx, "BPE_MERGES", 16)
    monkeypatch.setattr(Q, "BPE_VOCAB", 256 + 16 + 1)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    for name, sql in oracle.bpe_oracle_sql(16).items():
        want = con.execute(sql)
        columns = [d[0] for d in want.description]
        got = Q.QUERIES[name](spark, sf).select(*columns).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall())), name


def test_a_thousand_merges_equal_an_incremental_python_bpe(spark):
    """All merges of a real corpus, batched and checked by Spark, against plain counting of the words that hold a pair."""
    from collections import Counter, defaultdict
    from tokenloom.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    counts = bpe.pretoken_counts(Q._train_text(spark, sf))
    words = [(list(r.word.encode()), r.n) for r in counts.collect()]
    pairs, held = Counter(), defaultdict(set)
    for w, (ids, n) in enumerate(words):
        for p in zip(ids, ids[1:]):
            pairs[p] += n
            held[p].add(w)
    want = []
    for k in range(1000):
        (l, r), n = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        want.append((l, r, 256 + k, n))
        for w in held.pop((l, r)):
            ids, times = words[w]
            for p in zip(ids, ids[1:]):
                pairs[p] -= times
            out, i = [], 0
            while i < len(ids):
                two = ids[i:i + 2] == [l, r]
                out.append(256 + k if two else ids[i])
                i += 2 if two else 1
            words[w] = out, times
            for p in zip(out, out[1:]):
                pairs[p] += times
                held[p].add(w)
    for head_words in (1 << 19, 3000):  # the forecast sees all words, or a few of them only
        m = bpe.train_bpe(spark, counts, 256 + (1000 if head_words > 3000 else 150) + 1, head_words=head_words)
        got = [(r.l, r.r, r.id, r.freq) for r in m.merges.orderBy("rank").collect()]
        assert got == want[:len(got)] and len(got) in (1000, 150)


# --- tokenizer files --------------------------------------------------------------

FILE_TEXTS = ["the cat's hat, the fat cat  sat. \n\n It isn't 42!", "caf\u00e9 na\u00efve \U0001F600 the the the", "", "x",
              "a\uffffb \u00a0 tabs\tand  spaces   ", "\u4f60\u597d the \u4f60\u597d"]


def _encoded(spark, model, texts):
    merges, ids = bpe.encoder_tables(model)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    rows = bpe.encode_documents(docs, merges, ids_of_file=ids).collect()
    return [list(r.ids) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_tokenizer_files_round_trip_and_agree_with_another_reader(spark, tmp_path):
    from tokenizers import ByteLevelBPETokenizer
    from tokenloom.sources import tokenizer_files as TF
    docs = spark.createDataFrame([(t,) for t in FILE_TEXTS * 3], "text STRING")
    model = bpe.train_bpe(spark, bpe.pretoken_counts(docs), 256 + 40 + 1)
    out = str(tmp_path / "tok")
    TF.save_tokenizer_files(spark, model, out)
    back = TF.load_tokenizer_files(spark, out)

    def rows(df, *cols):
        return sorted(tuple(bytes(r[c]) if c == "token" else r[c] for c in cols) for r in df.collect())

    assert rows(back.vocab, "id", "token", "special") == rows(model.vocab, "id", "token", "special")
    assert rows(back.merges, "rank", "l", "r", "id") == rows(model.merges, "rank", "l", "r", "id")
    other = ByteLevelBPETokenizer(f"{out}/vocab.json", f"{out}/merges.txt")
    plain = [t for t in FILE_TEXTS if "\u00a0" not in t]
    assert _encoded(spark, back, plain) == [other.encode(t).ids for t in plain]


def test_hand_made_tokenizer_files_with_ids_in_any_order(spark, tmp_path):
    import json
    from tokenizers import ByteLevelBPETokenizer
    from tokenloom.sources import tokenizer_files as TF
    # a special first, bytes in reverse, and two merges that make one token
    tokens = ["<|endoftext|>", *(TF.CHAR_OF[b] for b in reversed(range(256))), "abc", "ab", "bc", "abcd", "\u0120a"]
    (tmp_path / "vocab.json").write_text(json.dumps({t: i for i, t in enumerate(tokens)}, ensure_ascii=False), "utf-8")
    (tmp_path / "merges.txt").write_text("#version: 0.2\nb c\na bc\na b\nab c\nabc d\n\u0120 a\n", "utf-8")
    model = TF.load_tokenizer_files(spark, str(tmp_path))
    assert [(r.id, bytes(r.token)) for r in model.vocab.filter("special").collect()] == [(0, b"<|endoftext|>")]
    other = ByteLevelBPETokenizer(str(tmp_path / "vocab.json"), str(tmp_path / "merges.txt"))
    texts = ["abcd abc ab bc a", "cab abcdabcd", "\u00e9 \n abx", ""]
    got = _encoded(spark, model, texts)
    assert got == [other.encode(t).ids for t in texts]
    assert [other.decode(i) for i in got] == texts
    (tmp_path / "merges.txt").write_text("#version: 0.2\nq q\n", "utf-8")
    with pytest.raises(ValueError, match="no id"):
        TF.load_tokenizer_files(spark, str(tmp_path))


def test_corpus_loss_over_bpe_ids_equals_plain_python(spark):
    import math
    from collections import Counter
    from tokenloom.operators import bigram
    docs = [("train", t) for t in FILE_TEXTS] + [("val", FILE_TEXTS[1]), ("val", ""), ("val", "the unseen cat")]
    df = spark.createDataFrame(docs, "split STRING, text STRING")
    model = bpe.train_bpe(spark, bpe.pretoken_counts(df.filter("split = 'train'")), 256 + 20 + 1)
    merges = bpe.merges_list(model)
    got = bigram.corpus_loss(bigram.bigram_counts(
        df.select("split", bpe.encode_stream(F.col("text"), merges).alias("data")), width=2), 277).first()
    ids = {t: x for t, x in zip([d[1] for d in docs], _encoded(spark, model, [d[1] for d in docs]))}
    pairs = [(s, a, b) for s, t in docs for a, b in zip(ids[t], ids[t][1:])]
    ab = Counter((a, b) for s, a, b in pairs if s == "train")
    row = Counter(a for s, a, _ in pairs if s == "train")
    val = [(a, b) for s, a, b in pairs if s == "val"]
    assert got.n_targets == len(val)
    assert math.isclose(got.loss, sum(-math.log((ab[p] + 1) / (row[p[0]] + 277)) for p in val) / len(val), rel_tol=1e-12)


def test_rounds_of_training_are_few_where_the_driver_holds_few_parts(spark, monkeypatch):
    """300 merges of a corpus with more distinct words than the driver holds: a round ends where parts get too many, not at a wrong guess."""
    from tokenloom.plans import queries as Q
    from tokenloom.session import ScratchTables
    written = []
    write = ScratchTables.write
    monkeypatch.setattr(ScratchTables, "write", lambda self, df, name: written.append(name) or write(self, df, name))
    counts = bpe.pretoken_counts(Q._train_text(spark, "/root/testdata/sf0.001"))
    few = bpe.train_bpe(spark, counts, 256 + 300 + 1, head_words=2000).merges.orderBy("rank").collect()
    assert written.count("words") <= 8
    assert few == bpe.train_bpe(spark, counts, 256 + 300 + 1).merges.orderBy("rank").collect()
