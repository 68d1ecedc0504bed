"""Each operator against a brute-force version, on a small table with the awkward rows:
nulls, empty and long texts, ties, repeated rows, clashing extra columns; and on an empty table."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from formsieve.llm import language, line_dedup, mixing, neighbours, packing, quality, simhash, token_counts, token_files, toxicity
from formsieve.llm.word_ids import CHUNK_PATTERN, WordIds

WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, fp string, piece int, n_tokens long, keep string, score string")
SPACE = " \t\n\x0b\x0c\r"


def make_rows():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice(["th", "en", "ö", "ing", "é", "A", "on", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = "This very line is found in several documents, " + say(6)
    texts = [None, "", " \n\t ", "\n\n", "short", "a b c", "1234 5678", "<|endoftext|>hi <|startoftext|> there",
             "tabs\tand\x0bother\x0cspaces\r\n  x", "é Å İ 日本語 テスト   wide", "it's we'll  two  spaces ",
             say(6000), "x" * 5000, "no-break space \x1c control"]
    for i in range(40):
        lines = [say(rng.randint(3, 30)) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), ("  " if i % 2 else "") + shared.upper() if i % 6 == 0 else shared)
        if i % 9 == 0:
            lines += [shared, lines[0]]
        texts.append("\n".join(lines))
    base = say(200)
    texts += [base, base, base.replace(" ", "  "), base + " end", base.upper()]
    rows = [(i, t, "ab"[i % 2] if i % 5 else None, [None, "s1", "s0", "s2", "s0"][i % 5], 0, 1, "clash", 9, 9, "clash", "clash") for i, t in enumerate(texts)]
    rows.append(rows[20])  # a repeated row
    rows.append((None, "a document without an id, " + say(30), "a", "s0", 0, 1, "", 9, 9, "", ""))
    return rows


ROWS = make_rows()
TEXT = {r[0]: r[1] for r in ROWS}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5, "doc_id")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


def library_ids(text):
    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ------------------------------------------------------------------ tokens

def test_word_ids_equal_the_library(spark):
    coder = WordIds(WORDS)
    assert coder.added is not None
    texts = [r[1] for r in ROWS] + ["Ü̈ber ẞ ſ ΑΣ ΑΣ.", "a.b,c. d, .e, ()., 'S", "é. é, Å"]
    tok = Tokenizer.from_file(WORDS)
    for t, ids in zip(texts, coder.batch([None if t is None else t.encode() for t in texts])):
        assert np.frombuffer(ids, coder.dtype).tolist() == tok.encode(t or "", add_special_tokens=False).ids, t


def test_word_ids_letter_shortcut_holds_for_every_letter():
    """Letters below U+0250 are their own pre-token, alone and between others."""
    coder, tok = WordIds(WORDS), Tokenizer.from_file(WORDS)
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = [x for c in letters for x in (c, f"a{c}b", f"{c}.")]
    for t, ids in zip(texts, coder.batch([t.encode() for t in texts])):
        assert np.frombuffer(ids, coder.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_word_ids_remember_a_word_once_whatever_marks_follow():
    coder = WordIds(WORDS)
    coder.batch([b"abcd Abcd. abcd, 2024, (abcd) abcd", b"", b"abcd... 2024."])
    assert set(coder.young) == {"abcd", "2024", "(abcd", "", ".", ",", ")", "..."}


def test_word_ids_of_letters_that_composing_changes():
    """Letters that end in a combining mark once normalised, seen before alone; capitals that compose otherwise than small letters."""
    coder, tok = WordIds(WORDS), Tokenizer.from_file(WORDS)
    parted = ["\u0130", "\u0958", "a\u0130", "\ufb1d", "\u0915\u093c"]
    composed = ["H\u0331a", "T\u0308", "W\u030a", "Y\u030a", "J\u030c", "h\u0331a", "I\u0307\u0338\u00c9", "E\u0301t\u00e9", "A\u0331."]
    for texts in (parted, [c + tail for c in parted for tail in (".", ",,%", "<")], composed, [f"The {c}, 12." for c in composed]):
        for t, ids in zip(texts, coder.batch([t.encode() for t in texts])):
            assert np.frombuffer(ids, coder.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, ascii(t)


def test_pre_tokens_agree_below_the_safe_end():
    import regex
    from formsieve.llm.token_counts import PRE_TOKEN, SAFE_END
    tok, find = Tokenizer.from_file(BYTES), regex.compile(PRE_TOKEN).findall
    for c in map(chr, range(ord(SAFE_END))):
        text = f"a{c}1{c} {c}{c}b{c}, {c}"
        spans = [text[s:e] for _, (s, e) in tok.pre_tokenizer.pre_tokenize_str(text)]
        assert spans == find(text), hex(ord(c))


def test_whole_tokens_are_proven():
    whole, tok = token_counts.whole_tokens(BYTES), Tokenizer.from_file(BYTES)
    assert len(whole) > 40_000
    assert all(len(tok.encode(w, add_special_tokens=False).ids) == 1 for w in random.Random(1).sample(whole, 2000))


def test_token_counts(docs, none):
    tok = Tokenizer.from_file(BYTES)
    got = token_counts.count_tokens(docs, BYTES, 512).collect()
    assert len(got) == len(ROWS)
    for r in got:
        n = len(tok.encode(TEXT[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((TEXT[r.doc_id] or "").encode()), n, n > 512)
    assert token_counts.count_tokens(none, BYTES, 512).collect() == []


def test_token_counts_by_sentencepiece(docs):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in token_counts.count_tokens(docs.where("doc_id < 20"), path, 512).collect():
        assert r.n_tokens == len(sp.encode(TEXT[r.doc_id] or "", num_threads=1))


def test_token_files_round_trip(spark, docs, none, tmp_path):
    manifest = token_files.write_token_files(docs, WORDS, folder=str(tmp_path / "shards"), row_len=16)
    got = token_files.read_token_files(spark, manifest, docs.schema["doc_id"].dataType).collect()
    got.sort(key=lambda r: r.start)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, w in zip(got, want, strict=True):
        ids = library_ids(w[1]) + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (w[0], start, len(ids), crc(ids))
        start += len(ids)
    import pyarrow as pa
    for f in {r.token_file for r in manifest.collect()}:
        reader = pa.ipc.open_file(f)
        batch = reader.get_batch(0)
        assert batch.schema.field("ids").type.list_size == 16 and batch.schema.field("mask").type.list_size == 16
    assert sum(pa.ipc.open_file(r.token_file).read_all()["mask"].combine_chunks().flatten().true_count for r in manifest.collect()) == start
    empty = token_files.write_token_files(none, WORDS, folder=str(tmp_path / "none"))
    assert token_files.read_token_files(spark, empty, none.schema["doc_id"].dataType).collect() == []


def test_token_files_cut_shards_by_id_of_any_type(spark, tmp_path):
    """One id holds a third of the rows; ids are texts, some null; documents stay in order over all shards."""
    rng = random.Random(2)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"é{rng.randint(0, 10 ** 6):x}", f"text {i % 700}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(6)
    cuts = token_files.shard_starts(df, 4, sample=600)
    assert cuts == sorted(cuts) and len(cuts) == 3
    manifest = token_files.write_token_files(df, WORDS, folder=str(tmp_path / "s"))
    assert manifest.count() > 1
    got = sorted(token_files.read_token_files(spark, manifest, df.schema["doc_id"].dataType).collect(), key=lambda r: r.start)
    key = lambda x: (x is not None, (x or "").encode())
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=key)
    tok = Tokenizer.from_file(WORDS)
    crcs = {t: crc(tok.encode(t, add_special_tokens=False).ids + [1]) for _, t in rows}
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((i, crcs[t]) for i, t in rows)


# ------------------------------------------------------------------ packing

def check_packing(rows, texts, capacity, end_id=0):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d, parts in by_doc.items():
        ids = library_ids(texts[d]) + [end_id]
        times = Counter(r[0] for r in ROWS)[d]
        assert sum(p.length for p in parts) == len(ids) * times
        for p in parts:
            assert p.start == p.piece * capacity and p.length == min(capacity, len(ids) - p.start)
            assert p.ids_crc32 == crc(ids[p.start:p.start + p.length])
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_packing(docs, none):
    rows = packing.pack(docs, WORDS, capacity=256).collect()
    assert len({r.doc_id for r in rows}) == len(TEXT)
    n = check_packing(rows, TEXT, 256)
    assert n <= 1.06 * sum(r.length for r in rows) / 256 + 1
    assert packing.pack(none, WORDS).collect() == []


def test_packing_tree_of_several_rounds(docs):
    rows = packing.pack(docs, WORDS, capacity=4096, fan_in=4, block=3).collect()
    n = check_packing(rows, TEXT, 4096)
    assert n <= 1.2 * -(-sum(r.length for r in rows) // 4096) + 1


def test_best_fit_takes_the_tightest_room():
    bins, at, fills = packing.best_fit(np.array([6, 5, 4, 4, 1]), 10)
    assert fills.tolist() == [10, 10] and bins.tolist() == [0, 1, 0, 1, 1] and at.tolist() == [0, 0, 6, 5, 9]


# ------------------------------------------------------------------ simhash

def brute_fingerprint(text):
    w = words(lower(text or ""))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    """Index of each fingerprint's component, by breadth-first search over all pairs."""
    fps, seen, part = np.array(fps, np.uint64), [-1] * len(fps), 0
    for i in range(len(fps)):
        if seen[i] < 0:
            todo, seen[i] = [i], part
            while todo:
                x = todo.pop()
                for y in np.flatnonzero(np.bitwise_count(fps ^ fps[x]) <= distance):
                    if seen[y] < 0:
                        seen[y] = part
                        todo.append(int(y))
            part += 1
    return seen


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    fps = [brute_fingerprint(r[1]) for r in ROWS]
    part = brute_components(fps, 4)
    least = defaultdict(list)
    for r, c in zip(ROWS, part):
        least[c].append(r[0])
    want = Counter((r[0], f - (1 << 64) if f >> 63 else f, min((x for x in least[c] if x is not None), default=None)) for r, f, c in zip(ROWS, fps, part))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got) == want
    assert simhash.near_duplicates(none).collect() == []
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(least) and {r.doc_id for r in kept} == {min((x for x in v if x is not None), default=None) for v in least.values()}


def test_keep_one_decides_by_component(spark):
    """Different texts under one id, and without an id, are documents of their own."""
    rng = random.Random(11)
    text = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(30)]
    rows = [(3, text[0]), (5, text[0]), (5, text[1]), (7, text[1])]  # id 5 in the components of 3 and of 5
    rows += [(9, t) for t in text[2:12]]  # several documents under an id
    rows += [(None, t) for t in text[12:24]]  # and without one
    rows += [(None, text[12])] * 3 + [(9, text[3])] * 2  # repeated rows
    rows += [(None, text[24]), (40, text[24]), (41, text[24])]  # a null id gives way
    rows += [(50, None), (50, ""), (None, "")]
    df = spark.createDataFrame([(i, t, {"n": 1}) for i, t in rows], "doc_id long, text string, extra map<string,int>").repartition(5)
    part = brute_components([brute_fingerprint(t) for _, t in rows], 4)
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(df).collect()]
    of = {r: c for r, c in zip(rows, part)}
    assert sorted(of[r] for r in kept) == sorted(set(part))  # one row of each component
    least = defaultdict(list)
    for (i, _), c in zip(rows, part):
        least[c].append(i)
    assert all(i == min((x for x in least[of[i, t]] if x is not None), default=None) for i, t in kept)


@pytest.mark.parametrize("max_shard", [20_000, 60])
def test_simhash_links_of_dense_clusters(spark, max_shard):
    """Chains and balls of near copies among random fingerprints, also with shards dealt into blocks."""
    rng = np.random.default_rng(3)
    fps = [rng.integers(0, 1 << 64, 400, dtype=np.uint64)]
    for c in rng.integers(0, 1 << 64, 4, dtype=np.uint64):
        ball = [int(c)]
        for _ in range(300):
            x = ball[int(rng.integers(len(ball)))]
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(b)
            ball.append(x)
        fps.append(np.array(ball, np.uint64))
    fps = np.unique(np.concatenate(fps))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    root = {r.node: r.root for r in simhash.connected(simhash.links(df, 4, max_shard)).collect()}
    got = [root.get(int(x), int(x)) for x in fps.view(np.int64)]
    part = brute_components(fps, 4)
    assert len(set(zip(got, part))) == len(set(got)) == len(set(part))


def test_block_masks_cover_every_pair():
    rng = random.Random(5)
    for blocks in (5, 6, 7, 8):
        masks = simhash.block_masks(blocks, 4)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not diff & m for m in masks)


def test_local_tree_uses_the_overlap():
    rng = np.random.default_rng(8)
    low = rng.integers(0, 1 << 20, 3000, dtype=np.uint64)  # few bits: distances spread, so the tree divides
    fps = np.unique(np.concatenate([low, low ^ np.uint64(5), rng.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    parent = {int(x): int(x) for x in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in simhash.search(fps, 1):
        for x, y in zip(a.tolist(), b.tolist()):
            parent[find(x)] = find(y)
    part = brute_components(fps, 1)
    got = [find(int(x)) for x in fps]
    assert len(set(zip(got, part))) == len(set(got)) == len(set(part))


# ------------------------------------------------------------------ lines

def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: lower(line.strip(SPACE))
    where = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= min_chars:
                where[key(line)].add(-(1 << 63) if r[0] is None else r[0])
    gone = {k: max(v) for k, v in where.items() if len(v) >= min_docs}
    return [(r[0], [x for x in (r[1] or "").split("\n") if gone.get(key(x), r[0]) == r[0]], (r[1] or "").count("\n") + 1) for r in rows]


def test_line_dedup(docs, none):
    maps = line_dedup.keep_bitmaps(docs)
    got = Counter(tuple(r) for r in line_dedup.digests(docs, maps).collect())
    want = Counter((d, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()) for d, kept, n in brute_lines(ROWS))
    assert got == want and sum(n - len(k) for _, k, n in brute_lines(ROWS)) > 10
    texts = Counter((r.doc_id, r.text, r.keep) for r in line_dedup.drop_lines(docs, maps).collect())
    assert texts == Counter((r[0], None if r[1] is None else "\n".join(k), r[9]) for r, (_, k, _) in zip(ROWS, brute_lines(ROWS)))
    assert line_dedup.digests(none, line_dedup.keep_bitmaps(none)).collect() == []


def test_line_dedup_of_a_hash_over_many_tasks(spark):
    """One line in most documents, spread by the range partitions over several tasks."""
    hot = "a line that nearly every document holds"
    rows = [(i, "\n".join([hot] * (1 + i % 3) + [f"own line number {i:020d}", f"a pair's line {i // 2:020d}", f"of four documents {i // 4:020d}"])) for i in range(3000)]
    rows += [(17, "another text of seventeen\n" + hot), (5000, "tail " + hot)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = Counter(tuple(r) for r in line_dedup.digests(df, line_dedup.keep_bitmaps(df)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == Counter((d, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()) for d, kept, n in brute_lines(rows))


# ------------------------------------------------------------------ quality

def brute_quality(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality(spark, docs, none):
    extra = [(900, "one two three four five six seven " * 3 + "# $ *"), (901, "same words\n" * 30), (902, "a b c d e a b c d e f"),
             (903, "good " + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))), (904, "- " + "\n- ".join("point " + chr(97 + i) * 5 for i in range(20)))]
    more = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    texts = {**TEXT, **dict(extra)}
    got = {r.doc_id: r for r in quality.judge(more).collect()}
    for d, t in texts.items():
        r, want = got[d], brute_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, d
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    assert got[903].kept and not got[904].kept
    assert quality.judge(none).collect() == []


def test_quality_exact_path_and_rule_order(docs):
    rules = {"slow": "length(regexp_replace(text, '(a|b|c|e|i|o)+x?', '')) < 0", "quick": "n_words > 0"}
    assert quality.rule_order(docs, rules)[0] == "quick"

    def docs_kept():
        return sorted((str(r.doc_id), r.kept) for r in quality.judge(docs).select("doc_id", "kept").collect())

    chars, quality.SAMPLE_CHARS = quality.SAMPLE_CHARS, -1  # only longer texts: nothing to measure, the verdicts stay
    try:
        assert sorted(quality.rule_order(docs)) == sorted(quality.RULES)
        without = docs_kept()
    finally:
        quality.SAMPLE_CHARS = chars
    assert without == docs_kept()
    bits, quality.POSITION_BITS = quality.POSITION_BITS, 3  # texts of over 7 words take the path for very long ones
    try:
        for r in quality.measures(docs).select("doc_id", "n_repeat_words").where("doc_id <> 11").collect():
            assert r.n_repeat_words == brute_quality(TEXT[r.doc_id])[4]
    finally:
        quality.POSITION_BITS = bits


# ------------------------------------------------------------------ language, toxicity

def test_suffix_automaton_phrases():
    rng = random.Random(2)
    text = "".join(rng.choice("abc") for _ in range(300))
    automaton = language.SuffixAutomaton(text)
    for _ in range(200):
        x, n, i = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))), 0, 0
        while i < len(x):
            j = i + 1
            while j < len(x) and x[i:j + 1] in text:
                j += 1
            i, n = j, n + 1
        assert automaton.phrases(x) == n


def test_language_id_on_the_given_table(spark, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = language.training_texts(language.learned_rows(docs))
    assert set(training) == {"de", "en", "es", "fr"}
    right = language.predict(docs, training).join(docs.where(language.held_out()), "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("x"), "score").collect()
    assert np.mean([r.x for r in right]) > 0.98 and all(0 <= r.score <= 1 for r in right)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? \n"), (4, "the of and that with")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd, training).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en"
    assert language.training_texts(none) == {} and language.predict(none, {}).collect() == []
    assert [r.lang_pred for r in language.predict(odd.where("doc_id = 4"), {}).collect()] == ["und"]
    assert sorted(r.doc_id for r in language.drop_unknown(odd, training).collect()) == [4]


def test_a_small_label_takes_nothing_from_the_others(spark):
    """Labels of very unequal size: the others' training text stays, and so do predictions."""
    from formsieve.llm.queries import table
    rows = language.learned_rows(table(spark, "/root/testdata/sf0.01", "documents"))
    tiny = rows.limit(1).withColumns({"doc_id": F.lit(10 ** 9), "text": F.lit("mimi napenda kusoma"), "lang": F.lit("xx")})
    before, after = language.training_texts(rows), language.training_texts(rows.unionByName(tiny))
    assert set(after) == {*before, "xx"} and after["xx"] == " mimi napenda kusoma "
    assert all(after[k] == v and len(v) == language.LETTERS_PER_LANGUAGE for k, v in before.items())
    held = table(spark, "/root/testdata/sf0.01", "documents").where(language.held_out())
    plain = {r["doc_id"]: r["lang_pred"] for r in language.predict(held, before).collect()}
    mixed = {r["doc_id"]: r["lang_pred"] for r in language.predict(held, after).collect()}
    assert sum(mixed[k] != v for k, v in plain.items()) <= 0.005 * len(plain)
    one = spark.createDataFrame([(1, "napenda kusoma mimi")], "doc_id long, text string")
    assert language.predict(one, after).first()["lang_pred"] == "xx"


def test_language_stage_keeps_documents_of_an_unlabelled_table(spark, docs):
    import corpus_pipeline as cp
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = cp.language_id(spark, bare, "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((r[0], r[1]) for r in ROWS if any(unicodedata.category(c)[0] == "L" for c in r[1] or ""))


def test_toxicity_held_out(spark, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(*toxicity.training_sample(docs, labels))
    insults = ["idiot", "moron", "stupid", "loser", "clown"]
    held = docs.join(labels.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0), "doc_id")
    got = toxicity.score(held, model).join(held.select("doc_id", "text", "toxic"), "doc_id").collect()
    clean = [r.predicted for r in got if r.toxic == 0]
    plain = [r.predicted for r in got if set(re.findall("[a-z]+", r.text.lower())) & set(insults)]
    assert np.mean(clean) < 0.05 and np.mean(plain) > 0.95
    said = ["you i d i o t there", "an id.i.ot", "you st-up.id", "you moroon", "the of and", "", None]
    odd = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    value = {r.doc_id: r for r in toxicity.score(odd, model).collect()}
    assert all(value[i].predicted == 1 for i in range(4)) and all(value[i].predicted == 0 for i in (4, 5, 6))
    assert all(0 <= r.score <= 1 for r in value.values())
    assert toxicity.score(none, model).collect() == []
    no_labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.train(*toxicity.training_sample(docs, no_labels)) == {}
    assert {r.score for r in toxicity.score(odd, {}).collect()} == {0.0}


def test_toxicity_sample_is_bounded(spark):
    """An id that most rows share, equal texts, and texts too long for the sample."""
    texts = [(1, f"you idiot number {i}") for i in range(300)] + [(2, "a clean one")] * 50 + [(3, "x " * toxicity.SAMPLE_CHARS), (4, None), (6, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("toxic", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (6, 0)], "doc_id long, toxic int")
    toxic, clean = toxicity.training_sample(docs, labels, folds=1, held=-1, toxic_docs=20, clean_docs=20)
    assert len(toxic) + len(clean) <= 80 and len(toxic) > 20 and len(clean) <= 1 and set(clean) <= {b"a clean one"}
    again = toxicity.training_sample(docs.repartition(7), labels, folds=1, held=-1, toxic_docs=20, clean_docs=20)
    assert (sorted(toxic), sorted(clean)) == (sorted(again[0]), sorted(again[1]))


def test_kernel_collapses_to_one_vector():
    units = [b"idiot", b"idxiot", b"aaaa", b"abcabcabc", b"xy{z"]
    index, value = toxicity.features(units)
    for u, i, v in zip(units, index, value):
        s, want = b"|" + u + b"}", Counter()
        for a in range(len(s)):
            for b in range(a + 1, len(s)):
                for c in range(b + 1, len(s)):
                    if c - a < toxicity.SPAN:
                        want[((s[a] - 97) * toxicity.SYMBOLS + s[b] - 97) * toxicity.SYMBOLS + s[c] - 97] += toxicity.DECAY ** (c - a - 2)
        norm = sum(x * x for x in want.values()) ** 0.5
        got = Counter()
        for k, x in zip(i.tolist(), v.tolist()):
            got[k] += x
        assert {k: round(x, 9) for k, x in got.items() if x} == {k: round(x / norm, 9) for k, x in want.items()}


# ------------------------------------------------------------------ mixing

def brute_targets(sizes):
    """Water level by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = 1.5 * sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            open_.discard(s)
    return target


def test_mixing(spark, docs, none):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * 3 for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", "c", None, "B", "é"]) if i % 3 else "a") for i in range(3000)]
    rows += [(1, rows[1][1], rows[1][2]), (None, None, None), (7000, None, "zero"), (7001, "", "zero")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.plan_mix(df, block=32).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(words(t))) for d, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want = brute_targets(sizes)
    source = {d: s for d, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and 0 <= r.copies <= 2
        taken[s] += r.copies * r.size
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    again = mixing.plan_mix(df.repartition(3), block=32).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    mixed = Counter(r.doc_id for r in mixing.mix(df, block=32).collect())
    assert mixed == Counter(r.doc_id for r in got for _ in range(r.copies))
    assert set(mixing.mix(docs).columns) == set(docs.columns) and mixing.mix(docs).count() > 0
    assert mixing.plan_mix(none).collect() == []


# ------------------------------------------------------------------ neighbours

def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.2, size=(400, 16)) for c in rng.normal(size=(8, 16))]).astype(np.float32)
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)]
    same = rows[100][1]
    rows += [(5000 + i, same, "") for i in range(0, 40)] + [rows[5]]
    bad = [(8000, None, ""), (8100, [], ""), (8200, [0.0] * 16, ""), (8300, [float("nan")] + [1.0] * 15, ""), (8400, [None] + [1.0] * 15, ""),
           (8500, [float("inf")] + [1.0] * 15, ""), (None, [1.0] * 16, ""), (8600, [1.0, 2.0], "")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, point string").repartition(4)
    got = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    full = dict((i, np.array(v, np.float64)) for i, v, _ in rows)
    ids, m = np.array(list(full)), np.stack(list(full.values()))
    asked = [i for i in full if i % 100 == 0]
    assert sorted(got) == sorted(asked)
    hits = 0
    for q in asked:
        d = np.sqrt(((m - full[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]].tolist()
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(s - np.sqrt(((full[v] - full[q]) ** 2).sum())) < 1e-12 for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits += len(set(best) & {v for _, v, _ in found})
        if q == 100 or q >= 5000:  # ties at distance 0 go to the smaller ids
            assert [v for _, v, _ in found] == best
    assert hits / (10 * len(asked)) >= 0.95
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>, point string")
    assert sorted((r.rank, r.query_id) for r in neighbours.search(few, F.col("vec_id") == 0).collect()) == [(1, 0), (2, 0), (3, 0)]
    assert neighbours.search(df.where("vec_id >= 8000"), F.lit(True)).where("vec_id is null").count() == 0
    assert neighbours.search(df.limit(0), F.lit(True)).collect() == []


def test_marks_before_a_key_and_id():
    rng = np.random.default_rng(3)
    marks = np.sort(neighbours.pairs(rng.integers(0, 5, 40), rng.integers(0, 9, 40)), order=("k", "i"))
    keys, ids = rng.integers(-1, 6, 300), rng.integers(0, 9, 300)
    assert neighbours.upto(marks, keys, ids).tolist() == [sum(m <= (k, i) for m in marks.tolist()) for k, i in zip(keys.tolist(), ids.tolist())]


def test_asks_keep_the_nearest_of_several_batches():
    rng = np.random.default_rng(4)
    x, ids = rng.normal(size=(700, 6)), np.arange(700)
    asks = neighbours.Asks(ids[:300], x[:300], 5)
    for at in (0, 2, 300, 650):
        asks.meet(ids[at:{0: 2, 2: 300, 300: 650, 650: 700}[at]], x[at:{0: 2, 2: 300, 300: 650, 650: 700}[at]])
    d = ((x[:300, None] - x[None]) ** 2).sum(2)
    d[np.arange(300), np.arange(300)] = np.inf
    assert (np.sort(asks.names, 1) == np.sort(np.argsort(d, 1)[:, :5], 1)).all()


def test_asks_measure_points_far_from_the_origin():
    rng = np.random.default_rng(8)
    x = np.concatenate([1e8 + rng.normal(size=(400, 6)), rng.normal(size=(5, 6))])
    asks = neighbours.Asks(np.arange(50), x[:50], 5)
    asks.meet(np.arange(200), x[:200])
    asks.meet(np.arange(200, 405), x[200:])
    d = ((x[:50, None] - x[None]) ** 2).sum(2)
    d[np.arange(50), np.arange(50)] = np.inf
    assert (asks.names == np.argsort(d, 1)[:, :5]).all()


@pytest.mark.parametrize("kind", ["near copies", "large common component"])
def test_neighbours_closer_than_a_code_step(spark, kind):
    """Thousands of near-copies of one vector, and vectors with one large common component: every point met counts."""
    rng = np.random.default_rng(9)
    if kind == "near copies":
        centre = rng.normal(size=64)
        x = centre / np.linalg.norm(centre) + rng.normal(0, 0.0003, size=(3000, 64))
    else:
        x = rng.normal(size=(3000, 64)) + 300 * np.eye(64)[0]
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.93 * 300


def test_window_follows_the_structure_of_the_vectors(spark):
    """Clustered vectors keep the least window, uniform ones get more, and both reach the recall."""
    rng = np.random.default_rng(5)
    clustered = np.concatenate([rng.normal(c, 0.01, size=(15, 24)) for c in rng.normal(size=(200, 24))])
    for x, wide in ((clustered, False), (rng.normal(size=(3000, 24)), True)):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        points = df.select(F.col("vec_id").alias("point"), F.col("embedding").alias("v"), (F.col("vec_id") % 20 == 0).alias("asks"))
        window = neighbours.measured_window(points, neighbours.Curves(x, 8), len(x), 10, 32)
        assert (window > 32) == wide
        got = defaultdict(set)
        for r in neighbours.search(df, F.col("vec_id") % 100 == 0, curves=8, least_window=32, max_blocks=40).collect():
            got[r.query_id].add(r.vec_id)
        hits = 0
        for q in range(0, 3000, 100):
            d = ((x - x[q]) ** 2).sum(1)
            d[q] = np.inf
            hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
        assert hits >= 0.9 * 300


def test_hilbert_key_steps_to_neighbours():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1).T
    key = neighbours.hilbert_key(cells, 3)
    path = cells[np.argsort(key)]
    assert sorted(key.tolist()) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, docs, none):
    import corpus_pipeline as cp
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "source_mix", "best_fit_packing"]
    from formsieve.llm.common import saved
    now, kept = docs, [r for r in ROWS if any(unicodedata.category(c)[0] == "L" for c in r[1] or "")]
    for name, stage in cp.STAGES[:-1]:
        now = saved(stage(spark, now, "/root/testdata/sf0.001"), name)
        assert now.columns == docs.columns
        rows = [tuple(r) for r in now.collect()]
        if name == "language_id":
            assert Counter(rows) == Counter(kept)
        elif name == "line_dedup":
            assert Counter((r[0], r[1]) for r in rows) == Counter((d, "\n".join(k)) for d, k, _ in brute_lines(kept))
        elif name == "simhash_dedup":
            assert len(rows) == len(set(brute_components([brute_fingerprint(r[1]) for r in kept], 4)))
        kept = rows
    pieces = cp.STAGES[-1][1](spark, now, "").collect()
    assert sum(p.length for p in pieces) == sum(len(library_ids(r[1])) + 1 for r in kept)
    empty = none
    for name, stage in cp.STAGES:
        empty = saved(stage(spark, empty, ""), name)
        assert empty.count() == 0


def test_helper_columns_dont_clash(spark):
    """Stages keep columns whose names their helpers have, in any case."""
    names = ["__h1", "__h2", "__ID", "__i", "__n", "__doc", "__Txt", "__keep", "__copies", "__rank", "__copy", "__k1"]
    line = "a line of more than twenty characters that three documents share"
    rows = [(i, f"{line}\nown words of document {i} " + "w%d " % i * 30, *[f"{c}{i}" for c in names]) for i in range(4)]
    rows += [rows[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)).withColumn("source", F.lit("s"))
    mine = lambda out: {(r["doc_id"], *[r[c] for c in names]) for r in out.collect()}
    want = {(r[0], *r[2:]) for r in rows}
    for out in (line_dedup.drop_lines(df, line_dedup.keep_bitmaps(df)), simhash.keep_one(df), mixing.mix(df)):
        assert out.columns == df.columns and mine(out) == want


def test_chunk_pattern_is_the_files():
    import json
    with open(WORDS, encoding="utf-8") as f:
        assert json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == CHUNK_PATTERN
