"""The operators over training documents against brute force, on small tables with every odd case."""

import collections
import hashlib
import random
import re
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pagemill import session
from pagemill.llm import best_fit, block_naming, byte_pairs, count_tree, graph, line_cleaning, prefix_counts, rule_ensemble, sampled_pieces, suffix_trees, text_convolution, warc_index

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, words string, label int"


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "the", "of", "Ünïcode", "x"]) + str(rng.randint(0, 30)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and blank texts, copies up to case, repeated rows, near copies, shared passages, one very long text, text without spaces."""
    rng = random.Random(5)
    base, passage, long_ = prose(rng, 120), prose(rng, 50), prose(rng, 9000)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        None, "", " \n\t ", "one", "One", "a b c", "a b c", base, base.upper().replace("Ü", "ü").replace("Ï", "ï"), " ".join(near), base + " tail", prose(rng, 70) + " " + passage + " " + prose(rng, 40),
        passage, prose(rng, 30) + " " + passage, long_, long_ + " end", "y" * 5000, "repeat " * 200, prose(rng, 34), prose(rng, 35), "é漢字 <|endoftext|> #$%\x1cz q " + prose(rng, 40),
        "Line one ends here.\nhome | about | shop | help\nLine two is a longer sentence, it ends here.\nhome\nLine one ends here.\nCopyright 2001 somebody, all rights reserved.",
    ]
    out = [(i, t, "en" if i % 3 else None, None, None, 7, "clash", i) for i, t in enumerate(texts)]
    out += [(4, "One", None, None, None, 7, "clash", 0), (4, "One", None, None, None, 7, "clash", 0), (7, "another text with id seven", "xx", "s", 1, 7, "c", 1), (None, base, "en", "s", 1, 7, "c", 1), (None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def bag(items=()):
    return collections.Counter(items)


LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.mark.parametrize("key", [block_naming.both_hashes, lambda b: F.struct((F.octet_length(b) % 3).alias("wide"), F.lit(1).alias("narrow"))])
@pytest.mark.parametrize("size", [7, 4096])
def test_block_naming(docs, rows, none, size, key):
    got = block_naming.exact_groups(docs, size=size, key=key).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    want = bag()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert bag((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    if size == 7:
        assert block_naming.exact_groups(none, size=size, key=key).count() == 0


def repeated(ws, width=5):
    count = collections.Counter(tuple(ws[i : i + width]) for i in range(len(ws) - width + 1))
    return len({i + k for i in range(len(ws) - width + 1) if count[tuple(ws[i : i + width])] > 1 for k in range(width)})


def test_line_cleaning(docs, rows, none):
    got = line_cleaning.line_cleaned(docs).collect()
    want = bag()
    for r in rows:
        ws, text = words(r[1]), r[1] or ""
        lines = [x for x in text.split("\n") if words(x)]
        n, rep = len(ws), repeated(ws)
        want[r[0], n, sum(len(w.decode()) for w in ws), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep, n < 10 or 100 * rep > 20 * n] += 1
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    menu = next(r for r in got if r.doc_id == 21)
    assert menu.cleaned_text == "Line one ends here.\nLine two is a longer sentence, it ends here.\nLine one ends here."
    assert not any(r.kept for r in got if r.base_failed)
    assert line_cleaning.line_cleaned(none).count() == 0


@pytest.mark.parametrize("members", [1, suffix_trees.MEMBERS])
@pytest.mark.parametrize("window,anchor", [(35, 8), (6, 3)])
def test_suffix_trees(docs, rows, none, members, window, anchor):
    got = suffix_trees.without_repeats(docs, window=window, anchor=anchor, members=members, keep=("lang", "words")).collect()
    lists = [words(r[1]) for r in rows]
    count = collections.Counter(tuple(ws[i : i + window]) for ws in lists for i in range(len(ws) - window + 1))
    want = bag()
    for r, ws in zip(rows, lists):
        gone = {i + k for i in range(len(ws) - window + 1) if count[tuple(ws[i : i + window])] > 1 for k in range(window)}
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        want[r[0], len(ws), len(gone), hashlib.sha256(kept).hexdigest(), r[2], r[6]] += 1
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.lang, r.words) for r in got) == want
    assert all(sum(x.words for x in r.repeats) == r.n_removed and all(x.words >= window for x in r.repeats) for r in got)
    if members == 1 and window == 35:
        assert suffix_trees.without_repeats(none).count() == 0


def test_prefix_counts(docs, rows, none):
    library = Tokenizer.from_file(public_tokenizers.path(prefix_counts.VOCABULARY))
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = prefix_counts.token_counts(docs, limit=100).collect()
    assert bag((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == bag((r[0], len((r[1] or "").encode()), count(r[1] or ""), count(r[1] or "") > 100) for r in rows)
    for r in got:
        text = next(x[1] or "" for x in rows if x[0] == r.doc_id and len((x[1] or "").encode()) == r.n_bytes)
        assert count(text[: r.fit_chars]) <= 100
        assert r.fit_chars == len(text) or all(count(text[:k]) > 100 for k in range(r.fit_chars + 1, min(len(text), r.fit_chars + 30)))
    assert prefix_counts.token_counts(none).count() == 0


def test_prefix_tables_of_odd_words():
    own = prefix_counts.counter(public_tokenizers.path(prefix_counts.VOCABULARY))
    count = lambda t: len(own.library.encode(t, add_special_tokens=False).ids)
    rng = random.Random(1)
    odd = ["don't", "a'll", "İstanbulΣΑΣς", "é́x", "12a½", "a<|endoftext|>b", "😀y", "x" * 230 + "'re!é" + "z" * 30]
    odd += ["".join(rng.choice("abcé'sl.,!#日́<|>12Ⅷ ") for _ in range(rng.randint(1, 20))) for _ in range(150)]
    for w in odd:
        assert own.prefixes(w) == [count(w[:k]) for k in range(len(w) + 1)], w


def test_prefix_tables_of_long_words_that_normalising_changes():
    own = prefix_counts.counter(public_tokenizers.path(prefix_counts.VOCABULARY))
    count = lambda t: len(own.library.encode(t, add_special_tokens=False).ids)
    rng = random.Random(3)
    han = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(300))
    jamo = unicodedata.normalize("NFD", "".join(chr(rng.randint(0xAC00, 0xD7A3)) for _ in range(120)))
    long_ = [
        han[:150] + "\u3000\u3000" + han[150:], jamo, unicodedata.normalize("NFD", "éàüñçőǖệ" * 40), "İxẞ" * 100, "x" * 150 + "<|endoftext|>" + han + "!<|startoftext|><|endoftext|>b<|endof",
        "é" * 100 + "İ" + "z" * 100, "'" + "l\u0301" * 150 + "'l\u0301'll" * 20, "\u3000" * 250 + "a", "\u0301" * 210 + "b\u0301\u0323" * 20, "a" + "\u0323\u0301" * 110, "\u0958\u0344\u2126\u212b" * 60, "=\u0338<\u0338'\u0338" * 70,
    ]
    long_ += ["".join(rng.choice("abcé'sltdm.,!#日\u0301\u0338\u1100\u1161\u11a8İ\u3000\u09c7\u09be<|>=12Ⅷ\x1c") for _ in range(220)) for _ in range(20)]
    long_ += ["".join(rng.choice(["'l", "l", "'", "\u0301", "\u0338", "e", "<|endoftext|>", "<|endof", "<", "漢", "\u2003"]) for _ in range(220)) for _ in range(20)]
    for w in long_:
        got, want = own.prefixes(w), [count(w[:k]) for k in range(len(w) + 1)]
        assert got == want, (w, next((k, a, b) for k, (a, b) in enumerate(zip(got, want)) if a != b))
    word = long_[0]
    assert own.within(word, count(word[:217])) == max(k for k in range(len(word) + 1) if count(word[:k]) <= count(word[:217]))


def test_byte_pairs_and_packing(docs, rows, none):
    library, own = Tokenizer.from_file(public_tokenizers.path(best_fit.VOCABULARY)), byte_pairs.byte_pairs(public_tokenizers.path(best_fit.VOCABULARY))
    rng = random.Random(2)
    odd = ["", " ", "\n", "a\n", "a  b", " a", "a \nb", "a\n\nb\n c", "x<|endoftext|> y<|endoftext|>\n", "  b\t c", "\x1c\x1f a"]
    odd += ["".join(rng.choice("ab é's .\n \t日 <|>1") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    for x in odd:
        assert np.frombuffer(own.ids(x), "<u4").tolist() == library.encode(x, add_special_tokens=False).ids, repr(x)
    got = best_fit.packed(best_fit.token_pieces(docs)).collect()
    want = bag()
    for r in rows:
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        want.update((r[0], k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    gapless(got, 2048)
    assert best_fit.packed(best_fit.token_pieces(none)).count() == 0


def gapless(pieces, capacity):
    sequences = collections.defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("capacity,lengths", [(50, (1, 50)), (50, (20, 30)), (7, (3, 3)), (100, (26, 60))])
def test_rounds_are_best_fit(spark, capacity, lengths):
    rng = random.Random(3)
    values = [rng.randint(*lengths) for _ in range(400)]
    pieces = spark.createDataFrame([(i, 0, 0, n) for i, n in enumerate(values)], "doc_id long, piece int, start long, length long")
    assert gapless(best_fit.packed(pieces, capacity).collect(), capacity) == best_fit_decreasing(values, capacity)


def test_warc_index(spark, tmp_path):
    big, odd = "<p>\r\n\r\nWARC/1.1\r\n" + "x" * 2000, "é" * 600
    data = [(1, "http://B.example.com/x?q=1", big), (5, "https://a.example.com:80/", big), (3, None, big), (2, "not a url", "small"), (9, "http://b.example.com/x?q=1", "small"),
            (7, "http://h/\n a", None), (8, "http://h/", ""), (11, "u", odd), (12, "u", odd), (12, "u", odd), (None, None, big), (None, "n", None), (13, "u", "y" * 999), (14, "u", "y" * 999)]
    pages = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, run string").repartition(4)
    pages.write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    got = warc_index.capture_history(pages).collect()
    want = bag()
    for i, _, html in data:
        payload = (html or "").encode()
        same = [r[0] for r in data if (r[2] or "").encode() == payload]
        top = max((x for x in same if x is not None), default=None) if len(payload) >= 1000 else i
        want[i, len(payload), hashlib.sha1(payload).hexdigest(), top if top != i else None] += 1
    twins = [r for r in got if r.page_id == 12]
    assert sorted((r.record_type, r.refers_to) for r in twins) == [("response", None), ("revisit", 12)]
    assert bag((r.page_id, r.payload_bytes, r.payload_digest, None if r.refers_to == r.page_id else r.refers_to) for r in got) == want
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)
    keys = [(r.url_key, r.captured_at) for r in got]
    assert keys == sorted(keys) and "com,example,b)/x?q=1" in {k for k, _ in keys}
    assert warc_index.capture_history(pages.filter("page_id < 0")).count() == 0


def test_loser_tree():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(warc_index.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


def shingles(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(a, b):
    both = len(a & b)
    return bool(both) and 100 * both >= 75 * (len(a) + len(b) - both)


@pytest.mark.parametrize("load", [count_tree.LOAD, 100])
def test_count_tree(docs, rows, none, load):
    got = count_tree.near_groups(docs, load=load).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == components([(r[0], r[1]) for r in rows])
    assert count_tree.near_groups(none).count() == 0


def components(texts):
    sets, root = [shingles(t) for _, t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if linked(sets[i], sets[j]) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    least = {}
    for (i, _), r in zip(texts, root):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return bag((i, len(s), least[r]) for (i, _), s, r in zip(texts, sets, root))


@pytest.mark.parametrize("load", [count_tree.LOAD, 3000])
def test_count_tree_finds_chains_of_copies(spark, tmp_path, load):
    rng = random.Random(9)
    texts = []
    for family in range(6):
        base = prose(rng, rng.choice([8, 40, 150])).split(" ")
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 99)}"
            texts.append((len(texts) * 3 % 1009, " ".join(copy[: len(copy) - rng.randint(0, len(base) // 10)])))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = count_tree.near_groups(spark.read.parquet(str(tmp_path / "t")), load=load).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == components(texts)


def test_graph_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    root = {x: x for ab in links for x in ab}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked_nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked_nodes}


def test_sampled_pieces(docs, rows, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sampled_pieces.VOCABULARY))
    got = sampled_pieces.sampled(docs)
    again = sampled_pieces.sampled(docs.repartition(1)).collect()
    back = sampled_pieces.decoded(got).collect()
    assert bag((r.doc_id, r.sample, r.ids_crc32) for r in back) == bag((r.doc_id, r.sample, r.ids_crc32) for r in again)  # by key, not by place
    assert all(r.round_trip for r in back)
    texts = collections.defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1] or "")
    for r in back:
        assert r.decoded in texts[r.doc_id] and model.decode(r.ids) == r.decoded and -np.inf < r.log_inclusion <= 0
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.n_tokens
    assert {r.doc_id: 0 for r in back}.keys() == {r[0] for r in rows}
    long_ = [r for r in back if r.doc_id == 14]
    assert [r.sample for r in sorted(long_, key=lambda r: -r.perturbed)] == [0, 1, 2] and len({tuple(r.ids) for r in long_}) == 3
    assert sampled_pieces.sampled(none).count() == 0


def test_sampled_pieces_follow_the_weights():
    pieces, text, n = sampled_pieces.pieces_of(public_tokenizers.path(sampled_pieces.VOCABULARY)), "xbe q", 20_000

    def ways(word):
        if not word:
            return [((), 0.0)]
        out = []
        for k in range(1, len(word) + 1):
            h = np.uint64(pieces.hash(word[:k]))
            at = min(int(np.searchsorted(pieces.hashes, h)), len(pieces.hashes) - 1)
            if pieces.hashes[at] == h and pieces.ids[at] >= 0:
                out += [((int(pieces.ids[at]), *rest), float(pieces.weights[at]) + w) for rest, w in ways(word[k:])]
        return out

    a, b = (ways(w) for w in sampled_pieces.words_of(text))
    chance = {x + y: np.exp(u + v) for x, u in a for y, v in b}
    total = sum(chance.values())
    chance = {k: v / total for k, v in chance.items()}
    first, weighed = collections.Counter(), collections.Counter()
    for paths, following in sampled_pieces.sample_slice(pieces, list(range(n)), [text] * n, 2):
        first[tuple(paths[0][0].tolist())] += 1
        for codes, log_p, _ in paths:
            weighed[tuple(codes.tolist())] += np.exp(log_p) / -np.expm1(-np.exp(log_p - following))
    for k, p in chance.items():
        assert abs(first[k] / n - p) < 5 * np.sqrt(p / n) + 1e-3
        assert abs(weighed[k] / n - p) < 0.02  # inclusion scores make the sample unbiased


@pytest.mark.parametrize("text", ["a   b", "  if\n    x  ", "     ", "e▁▁ f\n\n   g", "ab" + " " * 7 + "c"])
def test_sampled_pieces_of_runs_of_spaces(text):
    """All segmentations of the whole text, from the pieces of the model itself."""
    import sentencepiece

    path = public_tokenizers.path(sampled_pieces.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    weight = {model.id_to_piece(i): (i, -np.log(10.0 + r)) for r, i in enumerate(sorted(normal, key=lambda i: (-model.get_score(i), i)))}
    whole = "▁" + text.replace(" ", "▁")
    ends = [[((), 0.0)]]  # the ways to write each beginning
    for j in range(1, len(whole) + 1):
        steps = [(i, *weight[whole[i:j]]) for i in range(j) if whole[i:j] in weight]
        if whole[j - 1] not in weight:
            steps.append((j - 1, model.piece_to_id(f"<0x{ord(whole[j - 1]):02X}>"), sampled_pieces.BYTES))
        ends.append([((*path, code), w + step) for i, code, step in steps for path, w in ends[i]])
    total = np.logaddexp.reduce([w for _, w in ends[-1]])
    expected = {path: w - total for path, w in ends[-1]}
    (paths, _), = sampled_pieces.sample_slice(sampled_pieces.pieces_of(path), [1], [text], len(expected) + 1)
    got = {tuple(codes.tolist()): log_p for codes, log_p, _ in paths}
    assert len(paths) == len(got) and got.keys() == expected.keys() and tuple(model.encode(text)) in got
    assert all(abs(got[k] - w) < 1e-4 for k, w in expected.items())


def test_rows_keep_their_numbers_when_files_are_cut_anew(spark, docs, monkeypatch):
    columns = docs.select(*corpus_pipeline.COLUMNS)
    runs = {
        "repeats": lambda: suffix_trees.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"),
        "groups": lambda: count_tree.near_groups(docs).select("doc_id", "n_shingles", "component_id"),
        "exact": lambda: corpus_pipeline.exact(spark, columns, ""), "near": lambda: corpus_pipeline.near(spark, columns, ""), "substrings": lambda: corpus_pipeline.substrings(spark, columns, ""),
    }
    expected = {name: bag(run().collect()) for name, run in runs.items()}
    parts = set()

    def moved(df, written=session.written, **options):
        out = written(df, **options)
        spark.conf.set("spark.sql.files.minPartitionNum", {"1": "12", "12": "1"}[spark.conf.get("spark.sql.files.minPartitionNum")])
        parts.add(docs.select("text").rdd.getNumPartitions())
        return out

    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        for module in (suffix_trees, count_tree, block_naming, session):
            monkeypatch.setattr(module, "written", moved)
        for name, run in runs.items():
            assert bag(run().collect()) == expected[name], name
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(parts) > 1


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def tables(spark, size="sf0.01"):
    folder = f"/root/testdata/{size}"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_rule_ensemble_on_held_out_rows(spark, docs, none):
    documents, labels = tables(spark)
    model = rule_ensemble.fit(documents, labels)
    got = rule_ensemble.scored(documents.select("doc_id", "text"), model).join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(got.score.to_numpy(), got.quality.to_numpy()) > 0.97
    assert (got.predicted == got.quality).mean() > 0.95
    odd = rule_ensemble.scored(docs.select("doc_id", "text"), model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in odd if r.doc_id is not None)
    assert rule_ensemble.scored(none.select("doc_id", "text"), model).count() == 0
    assert {r.score for r in rule_ensemble.scored(docs.select("doc_id", "text"), rule_ensemble.fit(docs, labels.filter("doc_id < 0"))).collect()} == {0.5}
    one = labels.filter("quality = 1").unionByName(labels.select(F.lit(None).cast("long").alias("doc_id"), "quality", F.lit(None).cast("int").alias("toxic")))
    assert rule_ensemble.fit(documents, one).rules == []


def test_rules_compile_to_what_numpy_computes(spark):
    documents, labels = tables(spark)
    model = rule_ensemble.fit(documents, labels)
    rows = rule_ensemble.statistics(documents.select("doc_id", "text")).withColumn("score", model.score()).toPandas()
    assert np.allclose(model.predict(rows[list(rule_ensemble.STATISTICS)].to_numpy(float)), rows.score.to_numpy())


def test_text_convolution_on_held_out_rows(spark, docs, none):
    documents, labels = tables(spark, "sf0.1")
    model = text_convolution.fit(documents, labels, sample=1500)
    got = text_convolution.scored(documents, model).join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(got.score.to_numpy(), got.toxic.to_numpy()) > 0.9
    assert got[got.toxic == 1].predicted.mean() > 0.75 and got[got.toxic == 0].predicted.mean() < 0.02
    odd = text_convolution.scored(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert text_convolution.scored(none, model).count() == 0
    assert {r.score for r in text_convolution.scored(docs, text_convolution.fit(docs, labels.filter("doc_id < 0"))).collect()} == {0.5}


def slow_score(model, text):
    """The score of one text, word by word and window by window."""
    ends = text_convolution.ENDS.decode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w.decode().strip(ends).lower().encode()) for w in words(text)], np.uint64)
    known = set(model.known.tolist())
    zero = np.zeros(text_convolution.SIZE, np.float32)
    x = []
    for h in hashes:
        one, two = (int(text_convolution.mixed(np.array([v], np.uint64))[0]) % text_convolution.ROWS for v in (h, h ^ np.uint64(0xABCDEF)))
        x.append(model.tables[0][one] + model.tables[1][two] if int(h) in known else zero)
    x += [zero] * max(text_convolution.WIDTHS)
    pooled = []
    for w, b in zip(model.filters, model.biases):
        pooled.append(np.max([b + sum(x[i + j] @ w[j] for j in range(len(w))) for i in range(len(hashes) + 1)], axis=0))
    logit = float(np.maximum(np.concatenate(pooled), 0) @ model.out + model.intercept)
    return 1 / (1 + np.exp(-np.clip(model.scale[0] * logit + model.scale[1], -50, 50)))


def test_convolution_scores_by_a_slow_way_and_alone(spark, docs):
    documents, labels = tables(spark)
    long_ = F.when(F.col("doc_id") % 7 == 1, F.repeat(F.concat("text", F.lit(" ")), 60)).otherwise(F.col("text"))
    model = text_convolution.fit(documents.withColumn("text", long_), labels)
    assert model.tables
    some = documents.limit(40).collect() + [r for r in docs.collect() if len(r.text or "") < 20000]
    texts = [r.text for r in some]
    own = text_convolution.PlainWords()
    lists = [own.of((t or "").encode().split()) for t in texts]
    slow = np.array([slow_score(model, t) for t in texts])
    together = model.scores(*text_convolution.padded(lists))
    assert np.allclose(together, slow, atol=1e-5)
    alone = np.array([model.scores(*text_convolution.padded([x]))[0] for x in lists])
    assert np.allclose(alone, together, atol=1e-6)
    short = [text_convolution.distinct_windows(np.concatenate([x, x, x])) for x in lists]
    whole = model.scores(*text_convolution.padded([np.concatenate([x, x, x]) for x in lists]))
    assert np.allclose(model.scores(*text_convolution.padded(*map(list, zip(*short)))), whole, atol=1e-6)
    assert all(len(h) <= max(2 * len(x) + 6, 0) for (h, _), x in zip(short, lists))


def test_repeated_ids_train_on_the_same_text_however_dealt(spark):
    documents, labels = tables(spark, "sf0.001")
    twice = documents.unionByName(documents.withColumn("text", F.reverse("text")))
    ids = text_convolution.training_ids(labels, "quality", 100)
    one, other = (text_convolution.labelled(rows.select("doc_id", "text"), ids) for rows in (twice.repartition(3), twice.repartition(7, "text")))
    assert one.count() == ids.join(documents, "doc_id").select("doc_id").distinct().count() > 0
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_words_of_the_sample_are_bounded_and_long_texts_stay(spark):
    documents, labels = tables(spark, "sf0.001")
    model = text_convolution.fit(documents, labels, most_words=0)
    assert model.tables is None and model.intercept == 0.0


def test_pipeline_against_brute_force(spark, tmp_path, monkeypatch):
    documents, labels = tables(spark)
    rows = [r for r in documents.collect() if len(r.text) < 4000]
    rows.append(type(rows[0])(**(rows[3].asDict() | {"doc_id": 900_001})))
    clash = spark.createDataFrame(rows, documents.schema).withColumn("rid", F.lit(1)).withColumn("score", F.lit("clash"))
    clash.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, folder = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    quality, exact, near, substrings, packing = kept
    model = rule_ensemble.fit(spark.read.parquet(folder + "/documents.parquet"), labels)
    good = {r.doc_id for r in rule_ensemble.scored(spark.read.parquet(folder + "/documents.parquet").select("doc_id", "text"), model).collect() if r.predicted}
    assert {r.doc_id for r in quality} == good and 0.7 < len(good) / len(rows) < 1
    largest = {}
    for r in quality:
        t = r.text.translate(LOWER)
        largest[t] = max(largest.get(t, r.doc_id), r.doc_id)
    assert {r.doc_id for r in exact} == set(largest.values()) and len(exact) == len(largest)
    groups = components_fast([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted(set(groups.values()))
    lists = {r.doc_id: words(r.text) for r in near}
    count = collections.Counter(tuple(ws[i : i + 35]) for ws in lists.values() for i in range(len(ws) - 34))
    for r in substrings:
        ws = lists[r.doc_id]
        gone = {i + k for i in range(len(ws) - 34) if count[tuple(ws[i : i + 35])] > 1 for k in range(35)}
        assert r.text.encode() == b" ".join(w for i, w in enumerate(ws) if i not in gone) and r.n_chars == len(r.text)
    assert {r.doc_id for r in substrings} == set(lists) == {r.doc_id for r in packing}
    gapless(packing, 2048)


def components_fast(texts):
    sets, where, shared = {i: shingles(t) for i, t in texts}, collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        shared.update((a, b) for a in ids for b in ids if a < b)
    root = {i: i for i in sets}
    for a, b in sorted(shared):
        if linked(sets[a], sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return root


def test_all_ten_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
