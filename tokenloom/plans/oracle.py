"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver's pre-registered views. Shared fragments build
the same fixture frames as :mod:`.fixtures`; parameters are the fixed values
from there.
"""

from __future__ import annotations

from . import fixtures as fx

B = fx.BLOCK_SIZE

# Byte values of a text, as a DuckDB list of INTEGER.
def BYTES(expr: str) -> str:
    return (f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), "
            f"lambda h: ('0x' || h)::INTEGER)")


SPLIT = (f"CASE WHEN shard_id >= 0 AND shard_id < {fx.NUM_TRAIN} THEN 'train' "
         f"WHEN shard_id >= {fx.VAL_START} AND shard_id < {fx.VAL_START} + {max(1, round(fx.NUM_TRAIN * fx.VAL_PERCENT / 100))} "
         f"THEN 'val' ELSE 'unused' END")

CORPUS = f"""
corpus_all AS (
  SELECT source AS shard,
         CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS shard_id,
         doc_id, coalesce(text, '') AS text,
         CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_tok
  FROM documents),
corpus_split AS (SELECT *, {SPLIT} AS split FROM corpus_all),
corpus AS (SELECT * FROM corpus_split WHERE split <> 'unused'),
positioned AS (
  SELECT *, CAST(coalesce(sum(n_tok) OVER (PARTITION BY split ORDER BY shard_id, doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM corpus)"""

# One row per token: (split, p, b) with p the global position in the split stream.
TOKENS = f"""
tok_lists AS (SELECT split, pos, {BYTES('text')} AS l FROM positioned WHERE n_tok > 0),
tokens AS (
  SELECT split, pos + i - 1 AS p, b
  FROM (SELECT split, pos, unnest(l) AS b, generate_subscripts(l, 1) AS i FROM tok_lists))"""


def HEX(lst: str) -> str:
    """Upper-case hex of a list of byte values (Spark's ``hex(binary)``)."""
    return f"array_to_string(list_transform({lst}, lambda v: printf('%02X', v)), '')"


def R6(expr: str) -> str:
    """Same 6-decimal rounding as ``functions.numeric.round6``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


ORACLE: dict[str, str] = {}

ORACLE["shard_token_counts"] = _with(CORPUS, """
per AS (SELECT split, shard_id, shard, count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens
        FROM corpus GROUP BY split, shard_id, shard)""") + """
SELECT split, shard_id, shard, n_docs, n_tokens,
  CAST(sum(n_tokens) OVER (PARTITION BY split ORDER BY shard_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_tokens,
  CAST(sum(n_tokens) OVER (PARTITION BY split) AS BIGINT) AS split_tokens
FROM per"""

ORACLE["running_token_total"] = _with(CORPUS, """
per AS (SELECT split, shard_id, CAST(sum(n_tok) AS BIGINT) AS n_tokens FROM corpus GROUP BY split, shard_id)""") + """
SELECT split, shard_id, n_tokens,
  CAST(sum(n_tokens) OVER (PARTITION BY split ORDER BY shard_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_tokens
FROM per"""

ORACLE["shard_scan"] = _with(CORPUS) + f"""
SELECT shard, shard_id, CAST(sum(n_tok) AS BIGINT) AS n_tokens,
       CAST(sum(list_sum({BYTES('text')})) AS BIGINT) AS token_sum
FROM corpus_all GROUP BY shard, shard_id"""

ORACLE["byte_tokens"] = _with(CORPUS) + f"""
SELECT shard_id, doc_id, CAST(len(l) AS BIGINT) AS n_tok,
       CAST(coalesce(list_sum(l), 0) AS BIGINT) AS tok_sum,
       md5(array_to_string(l, ',')) AS ids_md5
FROM (SELECT shard_id, doc_id, {BYTES('text')} AS l FROM corpus_all)"""

ORACLE["global_positions"] = _with(CORPUS) + """
SELECT split, shard_id, doc_id, n_tok, pos FROM positioned"""

ORACLE["stream_chunks"] = _with(CORPUS, """
tot AS (SELECT split, CAST(sum(n_tok) AS BIGINT) AS n FROM corpus GROUP BY split HAVING sum(n_tok) > 0)""") + f"""
SELECT split, CAST(c AS BIGINT) AS chunk,
       CAST(least({fx.CHUNK_SIZE}, n - c * {fx.CHUNK_SIZE}) AS BIGINT) AS n_tokens,
       CAST(least((c + 1) * {fx.CHUNK_SIZE}, n) AS BIGINT) AS cum_tokens
FROM tot, range(0, (n + {fx.CHUNK_SIZE} - 1) // {fx.CHUNK_SIZE}) AS r(c)"""

ORACLE["pack_sequences"] = _with(CORPUS, TOKENS, f"""
m AS (SELECT split, p // {B} AS block, p, b FROM tokens
      UNION ALL
      SELECT split, p // {B} - 1 AS block, p, b FROM tokens WHERE p % {B} = 0 AND p >= {B}),
blk AS (SELECT split, block, list(b ORDER BY p) AS t FROM m GROUP BY split, block
        HAVING count(*) = {B + 1})""") + f"""
SELECT split, CAST(block AS BIGINT) AS block, {HEX('t[1:%d]' % B)} AS x_hex,
       {HEX('t[2:%d]' % (B + 1))} AS y_hex FROM blk"""

ORACLE["sample_windows"] = _with(CORPUS, TOKENS, f"""
tot AS (SELECT split, CAST(sum(n_tok) AS BIGINT) AS n FROM corpus WHERE split = 'train' GROUP BY split),
s AS (SELECT 'train' AS split, CAST(i // {fx.BATCH_SIZE} AS BIGINT) AS step,
             CAST(i % {fx.BATCH_SIZE} AS BIGINT) AS b
      FROM range(0, {fx.SAMPLE_STEPS * fx.BATCH_SIZE}) AS r(i)),
st AS (SELECT s.*, ('0x' || substr(md5('{fx.SEED}:' || s.split || ':' || CAST(step AS VARCHAR) || ':'
                   || CAST(b AS VARCHAR)), 1, 15))::BIGINT % (tot.n - {B}) AS start
       FROM s JOIN tot USING (split)),
sk AS (SELECT *, start // {B} AS k FROM st UNION ALL SELECT *, start // {B} + 1 AS k FROM st),
w AS (SELECT sk.split, sk.step, sk.b, sk.start, list(t.b ORDER BY t.p) AS l
      FROM sk JOIN tokens t ON t.split = sk.split AND t.p // {B} = sk.k
      WHERE t.p BETWEEN sk.start AND sk.start + {B}
      GROUP BY sk.split, sk.step, sk.b, sk.start)""") + f"""
SELECT split, step, b, start, {HEX('l[1:%d]' % B)} AS x_hex,
       {HEX('l[2:%d]' % (B + 1))} AS y_hex FROM w"""


# --- manifest ----------------------------------------------------------------

def _required_sql(num_train=fx.NUM_TRAIN, val_percent=fx.VAL_PERCENT, val_start=fx.VAL_START):
    num_val = max(1, round(num_train * val_percent / 100))
    return f"""
required AS (
  SELECT printf('data%02d.bin', id) AS file, CAST(id AS INTEGER) AS shard_id, 'train' AS split,
         CAST(id + 1 AS INTEGER) AS ordinal FROM range(0, {num_train}) AS r(id)
  UNION ALL
  SELECT printf('data%02d.bin', id), CAST(id AS INTEGER), 'val',
         CAST(id - {val_start} + {num_train} + 1 AS INTEGER) FROM range({val_start}, {val_start + num_val}) AS r(id))"""


MANIFEST = CORPUS + f""",
expected_src AS (
  SELECT printf('data%02d.bin', shard_id) AS file, CAST(shard_id AS BIGINT) AS sid,
         CAST(sum(n_tok) AS BIGINT) AS size FROM corpus_all GROUP BY shard_id),
lines AS (
  SELECT sid + 2 AS line_no, '-rw-r--r-- user/group ' || CAST(size AS VARCHAR)
         || ' 2024-01-01 00:00 tok105/' || file AS line FROM expected_src
  UNION ALL SELECT 0, 'drwxr-xr-x user/group 0 2024-01-01 00:00 tok105/'
  UNION ALL SELECT 1, '-rw-r--r-- user/group ' || CAST((SELECT sum(size) FROM expected_src) AS VARCHAR)
         || ' 2024-01-01 00:00 tok105/all.txt'),
parts AS (SELECT line_no, string_split_regex(trim(line), '\\s+') AS f FROM lines),
parsed AS (SELECT line_no, f[3] AS size_s, f[-1] AS path FROM parts),
expected AS (
  SELECT regexp_extract(path, '([^/]*)$', 1) AS file,
         arg_max(TRY_CAST(size_s AS BIGINT), line_no) AS size
  FROM parsed WHERE starts_with(path, 'tok105/') AND ends_with(path, '.bin')
  GROUP BY regexp_extract(path, '([^/]*)$', 1)),
existing AS (
  SELECT file, CASE WHEN sid % {fx.SHORT_MOD} = {fx.SHORT_REM} THEN size - 1 ELSE size END AS size
  FROM expected_src WHERE sid % {fx.MISSING_MOD} <> {fx.MISSING_REM}),"""

VERIFIED = _required_sql() + """,
verified AS (
  SELECT r.file, r.shard_id, r.split, r.ordinal, e.size AS expected_size, x.size AS actual_size,
         CASE WHEN x.size IS NULL THEN 'missing'
              WHEN e.size IS NULL THEN 'not_in_archive'
              WHEN x.size <> e.size THEN 'size_mismatch'
              ELSE 'verified' END AS status
  FROM required r LEFT JOIN existing x USING (file) LEFT JOIN expected e USING (file)),
plan_a AS (
  SELECT *, CAST(row_number() OVER (ORDER BY ordinal) AS INTEGER) AS extract_order
  FROM verified WHERE status <> 'verified')"""

ORACLE["parse_listing"] = "WITH " + MANIFEST.rstrip(",") + " SELECT file, size FROM expected"
ORACLE["required_shards"] = "WITH " + MANIFEST + _required_sql() + """
SELECT r.file, r.shard_id, r.split, r.ordinal, e.size AS expected_size
FROM required r LEFT JOIN expected e USING (file)"""
ORACLE["union_required"] = "WITH " + MANIFEST + VERIFIED + """
SELECT file, shard_id, split, ordinal, CASE WHEN status <> 'verified' THEN status END AS to_extract FROM verified"""
ORACLE["split_train_val"] = _with(CORPUS) + " SELECT doc_id, shard_id, split FROM corpus_split"
ORACLE["limit_shards"] = _with(CORPUS) + f"""
SELECT split, count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens FROM (
  SELECT n_tok, CASE WHEN shard_id >= 0 AND shard_id < 4 THEN 'train'
                     WHEN shard_id >= {fx.VAL_START} AND shard_id < {fx.VAL_START} + 1 THEN 'val'
                     ELSE 'unused' END AS split FROM corpus_all)
WHERE split <> 'unused' GROUP BY split"""
ORACLE["ordered_shards"] = _with(CORPUS) + """
SELECT shard, shard_id, n_docs, CAST(row_number() OVER (ORDER BY shard_id) AS INTEGER) AS order_rank
FROM (SELECT shard, shard_id, count(*) AS n_docs FROM corpus GROUP BY shard, shard_id)"""
ORACLE["verify_shards"] = "WITH " + MANIFEST + VERIFIED + " SELECT * EXCLUDE (extract_order) FROM plan_a WHERE false UNION ALL SELECT * FROM verified"
ORACLE["shards_to_extract"] = "WITH " + MANIFEST + VERIFIED + """
SELECT file, status, extract_order,
       CAST(row_number() OVER (ORDER BY CASE WHEN status = 'missing' THEN 0 ELSE 1 END, ordinal)
            AS INTEGER) AS extract_order_b
FROM plan_a"""
ORACLE["not_in_archive"] = "WITH " + MANIFEST + _required_sql(10, 10, 45) + """
SELECT r.* FROM required r ANTI JOIN expected e USING (file)"""
ORACLE["pending_files"] = "WITH " + MANIFEST + _required_sql() + """
SELECT r.* FROM required r ANTI JOIN existing e USING (file)"""
ORACLE["expected_bytes"] = "WITH " + MANIFEST + _required_sql() + """
SELECT CAST(coalesce(sum(e.size), 0) AS BIGINT) AS expected_bytes, count(*) AS n_files
FROM required r JOIN expected e USING (file)"""
ORACLE["all_verified"] = "WITH " + MANIFEST + VERIFIED + """
SELECT coalesce(bool_and(status = 'verified'), true) AS all_verified FROM verified"""
ORACLE["verify_summary"] = "WITH " + MANIFEST + VERIFIED + """
SELECT status, count(*) AS n_files FROM verified GROUP BY status"""
ORACLE["archive_count_check"] = "WITH " + MANIFEST.rstrip(",") + """
SELECT 'tok105.tar.gz' AS archive, count(*) AS n_listed,
       count(*) FILTER (WHERE TRY_CAST(f[3] AS BIGINT) IS NOT NULL AND len(f) >= 4) AS n_members,
       (count(*) = count(*) FILTER (WHERE TRY_CAST(f[3] AS BIGINT) IS NOT NULL AND len(f) >= 4)
        AND count(*) > 0) AS ok
FROM parts"""
ORACLE["extract_progress"] = "WITH " + MANIFEST + VERIFIED + """
SELECT file, CAST(row_number() OVER w AS INTEGER) AS i, CAST(count(*) OVER () AS INTEGER) AS n,
       CAST(coalesce(sum(coalesce(expected_size, 0)) OVER (ORDER BY extract_order
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS done_bytes,
       CAST(sum(coalesce(expected_size, 0)) OVER () AS BIGINT) AS total_bytes,
       CAST(floor(coalesce(sum(coalesce(expected_size, 0)) OVER (ORDER BY extract_order
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100
            / sum(coalesce(expected_size, 0)) OVER ()) AS BIGINT) AS percent,
       """ + R6("""coalesce(sum(coalesce(expected_size, 0)) OVER (ORDER BY extract_order
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100.0
            / sum(coalesce(expected_size, 0)) OVER ()""") + """ AS percent_exact
FROM plan_a WINDOW w AS (ORDER BY extract_order)"""

# --- text clean-up -------------------------------------------------------------

from ..functions import text as _T  # noqa: E402

WS = _T.WS_CLASS
GEN = """
gen AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, u.text || a.text AS text
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def _sq(s: str) -> str:
    return s.replace("'", "''")


def _rx(expr, pattern, repl=""):
    return f"regexp_replace({expr}, '{_sq(pattern)}', '{repl}', 'g')"


def _clean_sql(text="text", prompt="prompt"):
    t = _rx(f"replace({text}, '{_sq(_T.ESCAPE_LITERAL)}', '')", _T.ESCAPE_TRIPLE)
    n = f"length({prompt})"
    ctx = f"substring({t}, 1, {n})"
    gen = f"substring({t}, {n} + 1)"
    g = _rx(_rx(gen, WS + "+"), _T.PUNCT, "\\1 ")
    g = _rx(_rx(g, WS + "+", " "), "^" + WS + "+|" + WS + "+$")
    return _rx(f"({ctx} || {g})", _T.CONTROL)


def _gen_sql(expr):
    return "WITH " + GEN + f" SELECT conv_id, turn, {expr} AS out FROM gen"


def _turn_sql(expr):
    return r"""
WITH turns AS (
  SELECT conv_id, turn, text || ' \342\201\207,\101\102\103 \12!' || chr(7) || ' end ' AS text FROM conversations)
""" + f"SELECT conv_id, turn, {expr} AS out FROM turns"


ORACLE["clean_generated"] = _gen_sql(_clean_sql())
ORACLE["strip_literal"] = _turn_sql(f"replace(text, '{_sq(_T.ESCAPE_LITERAL)}', '')")
ORACLE["strip_escapes"] = _turn_sql(_rx("text", _T.ESCAPE_TRIPLE))
ORACLE["split_prefix"] = "WITH " + GEN + """
SELECT conv_id, turn, substring(text, 1, length(prompt)) AS context,
       substring(text, length(prompt) + 1) AS generated FROM gen"""
ORACLE["drop_whitespace"] = _turn_sql(_rx("text", WS + "+"))
ORACLE["space_after_punct"] = _turn_sql(_rx("text", _T.PUNCT, "\\1 "))
ORACLE["collapse_trim"] = _turn_sql(_rx(_rx("text", WS + "+", " "), "^" + WS + "+|" + WS + "+$"))
ORACLE["strip_control"] = _turn_sql(_rx("text", _T.CONTROL))
ORACLE["file_basename"] = "SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS basename FROM pages"
ORACLE["zero_pad_name"] = _with(CORPUS) + """
SELECT DISTINCT shard_id, printf('data%02d.bin', shard_id) AS file,
       printf('data%02d.bin', shard_id * 1000) AS wide_file FROM corpus_all"""
ORACLE["percent_done"] = _with(CORPUS, """
per AS (SELECT split, shard_id, CAST(sum(n_tok) AS BIGINT) AS n FROM corpus GROUP BY split, shard_id),
run AS (SELECT split, shard_id, sum(n) OVER (PARTITION BY split ORDER BY shard_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r, sum(n) OVER (PARTITION BY split) AS t
        FROM per)""") + """
SELECT split, shard_id, CASE WHEN t = 0 THEN NULL ELSE CAST(floor(r * 100 / t) AS BIGINT) END AS percent
FROM run"""

# --- training log ----------------------------------------------------------------

LOG = """
log AS (SELECT event_type AS run, event_id AS step, value AS loss, ts FROM events)"""

ORACLE["periodic_rows"] = "WITH " + LOG + f" SELECT run, step, loss FROM log WHERE step % {fx.EVAL_INTERVAL} = 0"
ORACLE["eval_loss"] = "WITH " + LOG + f"""
SELECT run, step - step % {fx.EVAL_INTERVAL} AS eval_step, {R6('avg(loss)')} AS mean_loss,
       count(*) AS n_batches
FROM log GROUP BY run, step - step % {fx.EVAL_INTERVAL}"""
ORACLE["eval_losses"] = f"""
WITH per AS (
  SELECT event_type AS run, event_id - event_id % {fx.EVAL_INTERVAL} AS step,
         avg(value) FILTER (WHERE user_id % 10 <> 0) AS train,
         avg(value) FILTER (WHERE user_id % 10 = 0) AS val,
         count(*) FILTER (WHERE user_id % 10 <> 0) AS train_batches,
         count(*) FILTER (WHERE user_id % 10 = 0) AS val_batches
  FROM events GROUP BY 1, 2)
SELECT run, step, {R6("train")} AS train_loss, {R6("val")} AS val_loss, train_batches, val_batches,
       coalesce(val < coalesce(min(CASE WHEN isnan(val) THEN NULL ELSE val END) OVER (
         PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         'inf'::DOUBLE), false) AS is_best
FROM per"""
ORACLE["best_summary"] = "WITH " + LOG + """
SELECT run, max(step) AS final_step, arg_max(loss, step) AS final_loss,
       min(CASE WHEN isnan(loss) THEN NULL ELSE loss END) AS best_loss, count(*) AS n_steps,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS total_seconds
FROM log GROUP BY run"""
ORACLE["running_best"] = "WITH " + LOG + """,
p AS (SELECT *, least(coalesce(min(CASE WHEN isnan(loss) THEN NULL ELSE loss END) OVER (
          PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
          'inf'::DOUBLE), 'inf'::DOUBLE) AS prev FROM log)
SELECT run, step, coalesce(loss < prev, false) AS is_best,
       CASE WHEN coalesce(loss < prev, false) THEN loss ELSE prev END AS best_so_far FROM p"""
ORACLE["running_avg_loss"] = "WITH " + LOG + """
SELECT run, step, """ + R6("""avg(loss) OVER (PARTITION BY run ORDER BY step
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""") + """ AS running_avg FROM log"""
ORACLE["step_timing"] = "WITH " + LOG + """
SELECT run, step,
       (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run))) / 1e6 AS elapsed_s,
       (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run ORDER BY step))) / 1e6 AS dt_s,
       """ + R6("""CASE WHEN max(step) OVER (PARTITION BY run) > 0
             THEN step * 100.0 / max(step) OVER (PARTITION BY run) END""") + """ AS pct_done,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
FROM log"""
ORACLE["checkpoint_pick"] = f"""
WITH c AS (
  SELECT event_type AS run, CAST(user_id % 3 AS INTEGER) AS priority,
         bool_or(NOT isnan(value) AND value < {fx.USABLE_BELOW}) AS usable
  FROM events GROUP BY event_type, user_id % 3),
f AS (SELECT run, (['model_best.pt', 'checkpoint.pt', 'model.pt'])[priority + 1] AS file,
             priority, usable FROM c),
p AS (SELECT run, arg_min(file, priority) AS file, min(priority) AS priority
      FROM f WHERE usable GROUP BY run)
SELECT r.run, p.file, p.priority FROM (SELECT DISTINCT run FROM f) r LEFT JOIN p USING (run)"""
ORACLE["softmax_sample"] = f"""
WITH c AS (SELECT user_id AS grp, event_id AS item, value / {fx.TEMPERATURE} AS z FROM events),
e AS (SELECT grp, item, exp(z - max(z) OVER (PARTITION BY grp)) AS e FROM c),
s AS (SELECT grp, item, e, sum(e) OVER (PARTITION BY grp) AS zt, count(*) OVER (PARTITION BY grp) AS n_items,
             coalesce(sum(e) OVER (PARTITION BY grp ORDER BY item
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             ('0x' || substr(md5('{fx.SEED}:' || CAST(grp AS VARCHAR)), 1, 15))::BIGINT / {float(2 ** 60)} AS u
      FROM e)
SELECT grp, arg_max(item, item) AS item, {R6('arg_max(e / zt, item)')} AS prob, n_items
FROM s WHERE before <= u * zt GROUP BY grp, n_items"""


# --- token stream, continued ------------------------------------------------------

TOT = """
tot AS (SELECT split, CAST(sum(n_tok) AS BIGINT) AS n FROM corpus GROUP BY split),
firsts AS (SELECT t.split, t.p // %d AS block, t.b AS first FROM tokens t JOIN tot USING (split)
           WHERE t.p %% %d = 0 AND t.p + %d <= tot.n - 1)""" % (B, B, B)

ORACLE["rank_shards"] = _with(CORPUS, TOKENS, TOT) + f"""
SELECT split, CAST(block % {fx.WORLD_SIZE} AS INTEGER) AS rank, count(*) AS n_blocks,
       CAST(sum(block) AS BIGINT) AS block_sum, CAST(sum(first) AS BIGINT) AS x_first_sum
FROM firsts GROUP BY split, block % {fx.WORLD_SIZE}"""

ORACLE["batch_rows"] = _with(CORPUS, TOKENS, TOT) + f"""
SELECT split, block // {fx.BATCH_SIZE} AS batch, count(*) AS n_rows,
       min(block) AS first_block, max(block) AS last_block
FROM firsts GROUP BY split, block // {fx.BATCH_SIZE}"""

DOC_BYTES = f"""
db AS (SELECT doc_id, shard_id, {BYTES('text')} AS l FROM corpus_all)"""

ORACLE["tail_context"] = _with(CORPUS, DOC_BYTES) + f"""
SELECT doc_id, array_to_string(l[greatest(len(l) - {B - 1}, 1):], ',') AS ids FROM db"""

ORACLE["truncate_at_stop"] = _with(CORPUS, DOC_BYTES) + f"""
SELECT doc_id, array_to_string(CASE WHEN coalesce(list_position(l, {fx.STOP_BYTE}), 0) > 0
       THEN l[1:list_position(l, {fx.STOP_BYTE})] ELSE l END, ',') AS ids FROM db"""

ORACLE["vocab_range_check"] = _with(CORPUS, DOC_BYTES) + f"""
SELECT shard_id, CAST(sum(len(list_filter(l, lambda x: x < 0 OR x >= {fx.VOCAB_BYTES}))) AS BIGINT)
       AS n_out_of_range FROM db GROUP BY shard_id"""

ORACLE["explode_tokens"] = _with(CORPUS, TOKENS) + " SELECT split, p AS pos, b AS tok FROM tokens"

ORACLE["next_token_pairs"] = _with(CORPUS, TOKENS) + """
SELECT split, tok, next_tok, count(*) AS n FROM (
  SELECT split, b AS tok, lead(b) OVER (PARTITION BY split ORDER BY p) AS next_tok FROM tokens)
WHERE next_tok IS NOT NULL GROUP BY split, tok, next_tok"""

ORACLE["corpus_loss"] = _with(CORPUS, f"""
dl AS (SELECT split, {BYTES('text')} AS l FROM corpus),
bi AS (SELECT split, a, b, count(*) AS n FROM (
         SELECT split, unnest(l[1:len(l) - 1]) AS a, unnest(l[2:len(l)]) AS b FROM dl)
       GROUP BY split, a, b),
tr AS (SELECT a, b, n AS c_ab FROM bi WHERE split = 'train'),
rw AS (SELECT a, sum(c_ab) AS c_a FROM tr GROUP BY a),
ev AS (SELECT a, b, n AS m FROM bi WHERE split = 'val')""") + """
SELECT CAST(sum(m) AS BIGINT) AS n_targets,
       """ + R6("sum(-ln((coalesce(c_ab, 0) + 1) / (coalesce(c_a, 0) + 256)) * m) / sum(m)") + """ AS loss
FROM ev LEFT JOIN tr USING (a, b) LEFT JOIN rw USING (a)"""

# --- tokenizer ----------------------------------------------------------------------
# RE2 has no look-ahead. The whitespace run that GPT-2's \s+(?!\S) leaves
# behind is its last character before a non-space; we mark that character with
# \x01 (absent from the corpus) and let an optional marker start the tokens.

_WSC = WS[1:-1]
PRETOKEN_RE2 = (r"'s|'t|'re|'ve|'m|'ll|'d|\x01? ?\p{L}+|\x01? ?\p{N}+"
                rf"|\x01? ?[^{_WSC}\p{{L}}\p{{N}}\x01]+|\x01?[{_WSC}]+")
MARK = f"regexp_replace(text, '([{_WSC}])([^{_WSC}])', chr(1) || '\\1\\2', 'g')"

WORDS_WC = f"""
train_text AS (SELECT text FROM documents
               WHERE CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) < {fx.NUM_TRAIN}),
marked AS (SELECT {MARK} AS t FROM train_text),
wc AS (SELECT word, count(*) AS n FROM (
         SELECT replace(unnest(regexp_extract_all(t, '{_sq(PRETOKEN_RE2)}')), chr(1), '') AS word
         FROM marked) GROUP BY word)"""

WORDS = WORDS_WC + f""",
wb AS (SELECT {BYTES('word')} AS l, n FROM wc),
pc AS (SELECT pl AS l, pr AS r, CAST(sum(n) AS BIGINT) AS n FROM (
         SELECT unnest(l[1:len(l) - 1]) AS pl, unnest(l[2:len(l)]) AS pr, n FROM wb)
       GROUP BY pl, pr HAVING sum(n) >= 2)"""

ORACLE["pretoken_counts"] = _with(WORDS) + " SELECT word, n FROM wc"
ORACLE["bpe_pair_counts"] = _with(WORDS) + " SELECT l, r, n FROM pc"
ORACLE["top_pair"] = _with(WORDS) + " SELECT l, r, n FROM pc ORDER BY n DESC, l, r LIMIT 1"
ORACLE["special_tokens"] = f"""
SELECT CAST(i AS INTEGER) AS id, printf('%02X', i) AS token_hex, false AS special FROM range(0, 256) AS r(i)
UNION ALL SELECT {256 + fx.BPE_MERGES}, hex(encode('<|endoftext|>')), true"""
ORACLE["decode_tokens"] = """
SELECT doc_id, md5(coalesce(text, '')) AS text_md5, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars
FROM documents"""

ORACLE["append_tokens"] = _with(CORPUS, DOC_BYTES) + f"""
SELECT doc_id, array_to_string(list_append(l[greatest(len(l) - {B - 2}, 1):],
       CAST((('0x' || substr(md5('{fx.SEED}:' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % 256) AS INTEGER)),
       ',') AS ids FROM db"""
ORACLE["name_filter"] = "WITH " + MANIFEST.rstrip(",") + """
SELECT line_no, f[-1] AS path FROM parts
WHERE starts_with(f[-1], 'tok105/') AND ends_with(f[-1], '.bin')
  AND regexp_extract(f[-1], '([^/]*)$', 1) <> 'data00.bin'"""


# --- BPE training, unrolled -------------------------------------------------------
# Same representation as the Spark code: one code point per token (byte b is
# chr(b), merge k is chr(256 + k)), a merge is a literal replace. Each level
# is materialised so the unrolled chain stays linear.

NOMATCH = "chr(65534) || chr(65534)"


def _chars(expr: str) -> str:
    return f"array_to_string(list_transform({BYTES(expr)}, lambda b: chr(b)), '')"


def _pat(k: int) -> str:
    return f"coalesce((SELECT p FROM best_{k}), {NOMATCH})"


def _bpe_ctes(n_merges: int) -> str:
    parts = [WORDS_WC, f"""
w_0 AS MATERIALIZED (SELECT n, {_chars('word')} AS s FROM wc)"""]
    for k in range(n_merges):
        parts.append(f"""
pc_{k} AS MATERIALIZED (
  SELECT p, sum(n) AS n FROM (
    SELECT n, unnest(list_transform(range(1, length(s)), lambda i: substr(s, i, 2))) AS p FROM w_{k})
  GROUP BY p),
best_{k} AS MATERIALIZED (
  SELECT p, CAST(n AS BIGINT) AS freq, unicode(substr(p, 1, 1)) AS l, unicode(substr(p, 2, 1)) AS r
  FROM pc_{k} WHERE n >= 2 ORDER BY n DESC, l, r LIMIT 1),
w_{k + 1} AS MATERIALIZED (SELECT n, replace(s, {_pat(k)}, chr({256 + k})) AS s FROM w_{k})""")
    parts.append("""
merges AS (""" + "\n  UNION ALL ".join(
        f"SELECT {k} AS rank, l, r, {256 + k} AS id, freq FROM best_{k}" for k in range(n_merges)) + ")")
    return ",".join(parts)


def _encode_sql(text: str, n_merges: int) -> str:
    """Encoded token string of ``text`` (pre-tokens joined by U+FFFF while merging)."""
    marked = f"regexp_replace({text}, '([{_WSC}])([^{_WSC}])', chr(1) || '\\1\\2', 'g')"
    words = (f"list_transform(regexp_extract_all({marked}, '{_sq(PRETOKEN_RE2)}'), "
             f"lambda w: replace(w, chr(1), ''))")
    s = f"array_to_string(list_transform({words}, lambda w: {_chars('w')}), chr(65535))"
    for k in range(n_merges):
        s = f"replace({s}, {_pat(k)}, chr({256 + k}))"
    return f"replace({s}, chr(65535), '')"


def _vocab_hex_ctes(n_merges: int) -> str:
    parts = ["""
hx_0 AS MATERIALIZED (SELECT CAST(i AS INTEGER) AS id, printf('%02X', i) AS hx FROM range(0, 256) AS t(i))"""]
    for k in range(n_merges):
        parts.append(f"""
hx_{k + 1} AS MATERIALIZED (
  SELECT * FROM hx_{k}
  UNION ALL
  SELECT {256 + k}, (SELECT hx FROM hx_{k} WHERE id = b.l) || (SELECT hx FROM hx_{k} WHERE id = b.r)
  FROM best_{k} b)""")
    return ",".join(parts)


def bpe_oracle_sql(n_merges: int) -> dict[str, str]:
    """SQL of the queries that depend on the merges, unrolled level by level: for a short merge list.

    The registered tokenizer has too many merges for it, so its queries have no oracle; tests compare them with this
    SQL for 16 merges, and with a plain Python BPE."""
    out, bpe = {}, _bpe_ctes(n_merges)
    out["bpe_train"] = "WITH " + bpe + """
SELECT CAST(rank AS INTEGER) AS rank, CAST(l AS INTEGER) AS l, CAST(r AS INTEGER) AS r,
       CAST(id AS INTEGER) AS id, freq FROM merges"""

    out["bpe_encode"] = "WITH " + bpe + f""",
de AS (SELECT doc_id, {_encode_sql("coalesce(text, '')", n_merges)} AS t FROM documents)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_ids,
       CASE WHEN t = '' THEN md5('') ELSE md5(unhex(array_to_string(list_transform(string_split(t, ''),
            lambda c: printf('%02X%02X', unicode(c) % 256, unicode(c) // 256)), ''))) END AS ids_md5
FROM de"""

    out["encode_corpus"] = "WITH " + bpe + "," + CORPUS + f""",
de AS (SELECT split, shard_id, doc_id, {_encode_sql('text', n_merges)} AS t FROM corpus),
per AS (SELECT split, shard_id, CAST(shard_id AS VARCHAR) AS shard, count(*) AS n_docs,
               CAST(sum(length(t)) AS BIGINT) AS n_tokens FROM de GROUP BY split, shard_id)
SELECT split, shard_id, shard, n_docs, n_tokens,
  CAST(sum(n_tokens) OVER (PARTITION BY split ORDER BY shard_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_tokens,
  CAST(sum(n_tokens) OVER (PARTITION BY split) AS BIGINT) AS split_tokens
FROM per"""


    out["tokenizer_tables"] = "WITH " + bpe + "," + _vocab_hex_ctes(n_merges) + f""",
vocab AS (
  SELECT id, hx AS token_hex, false AS special FROM hx_{n_merges}
  UNION ALL SELECT CAST(256 + (SELECT count(*) FROM merges) AS INTEGER), hex(encode('<|endoftext|>')), true)
SELECT v.id, v.token_hex, v.special, CAST(m.rank AS INTEGER) AS rank, CAST(m.l AS INTEGER) AS l,
       CAST(m.r AS INTEGER) AS r
FROM vocab v LEFT JOIN merges m USING (id)"""

    out["token_to_id"] = "WITH " + bpe + "," + _vocab_hex_ctes(n_merges) + f""",
vocab AS (
  SELECT id, hx AS token_hex FROM hx_{n_merges}
  UNION ALL SELECT CAST(256 + (SELECT count(*) FROM merges) AS INTEGER), hex(encode('<|endoftext|>')))
SELECT w.word, v.id FROM wc w LEFT JOIN vocab v ON hex(encode(w.word)) = v.token_hex"""
    return out


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

# --- file sources, sinks and streams ---------------------------------------------------

ORACLE["shard_files_scan"] = _with(CORPUS) + f"""
SELECT shard, CAST(sum(n_tok + 1) AS BIGINT) AS n_tokens,
       CAST(sum(coalesce(list_sum({BYTES('text')}), 0) + 10) AS BIGINT) AS token_sum
FROM corpus_all GROUP BY shard"""
ORACLE["text_scan"] = """
SELECT source AS shard, CAST(sum(length(coalesce(text, '')) + 1) AS BIGINT) AS n_chars
FROM documents GROUP BY source"""
ORACLE["list_dir"] = _with(CORPUS) + """
SELECT shard, CAST(sum(n_tok + 1) AS BIGINT) AS size FROM corpus_all GROUP BY shard"""
ORACLE["token_sink"] = _with(CORPUS) + """
SELECT split, count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens FROM corpus GROUP BY split"""
ORACLE["stream_ingest_shards"] = _with(CORPUS) + """
SELECT shard_id, count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens FROM corpus GROUP BY shard_id"""
ORACLE["stream_token_totals"] = ORACLE["token_sink"].replace(
    "count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens",
    "CAST(sum(n_tok) AS BIGINT) AS n_tokens, count(*) AS n_docs")
ORACLE["stream_best_loss"] = """
SELECT event_type AS run, min(CASE WHEN isnan(value) THEN NULL ELSE value END) AS best_loss,
       count(*) AS n_rows FROM events GROUP BY event_type"""
ORACLE["stream_best_flags"] = ORACLE["running_best"]
ORACLE["stream_ingest_files"] = ORACLE["shard_files_scan"]
ORACLE["limit_shards_pruned"] = ORACLE["limit_shards"]
ORACLE["sample_windows_stored"] = ORACLE["sample_windows"]
