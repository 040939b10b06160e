import __spark_entry__ as E

INVENTORY = """
shard_scan text_scan parse_listing list_dir token_sink tokenizer_tables pending_files
required_shards split_train_val periodic_rows name_filter
verify_shards shards_to_extract not_in_archive token_to_id decode_tokens
shard_token_counts expected_bytes all_verified verify_summary archive_count_check eval_loss
best_summary pretoken_counts corpus_loss
running_token_total extract_progress running_best running_avg_loss next_token_pairs
checkpoint_pick step_timing
byte_tokens global_positions stream_chunks append_tokens pack_sequences sample_windows
rank_shards batch_rows tail_context truncate_at_stop vocab_range_check explode_tokens
bpe_pair_counts bpe_train bpe_encode encode_corpus special_tokens
strip_literal strip_escapes split_prefix drop_whitespace space_after_punct collapse_trim
clean_generated strip_control file_basename zero_pad_name percent_done softmax_sample
ordered_shards limit_shards top_pair union_required
stream_ingest_shards stream_token_totals stream_best_loss
""".split()


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "block", "x_hex", "y_hex"]
    rows = df.limit(3).collect()
    assert rows and all(len(r.x_hex) == 2 * 256 and r.x_hex[2:] == r.y_hex[:-2] for r in rows)


def test_every_inventory_key_is_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(INVENTORY) <= set(q), sorted(set(INVENTORY) - set(q))
