"""Each operator against a brute-force version, and on nulls, empty and long texts, repeats and empty tables."""

import hashlib
import itertools
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import chunks, decontaminate, licences, lm, minhash, packing, quality, tokens, urls
from stratum.llm.chat import Template, escaped, formatted, read_back, unescaped

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, id string, measures string"
BLANK = r"[^\x20\x09-\x0D]+"


def words_of(text, lower=True):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(BLANK, text)


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ba", "ko", "ti", "ré", "su", "Zu", "ch"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    base = [sentence(rng, rng.randint(30, 200)) for _ in range(30)]
    out = dict(enumerate(base))
    for k in range(10):          # near copies: a few words changed
        w = base[k].split(" ")
        for _ in range(max(1, len(w) // 60)):
            w[rng.randrange(len(w))] = "changed"
        out[100 + k] = " ".join(w)
    passage = sentence(rng, 70)
    for k in range(4):           # one passage in otherwise different texts, shifted by different amounts
        out[200 + k] = f"{sentence(rng, 20 + 7 * k)}\n{passage}\n{sentence(rng, 15)}"
    out |= {300: base[0], 301: None, 302: "", 303: "\n \t", 304: "one", 305: "ONE", 306: "one two three",
            307: " ".join(sentence(rng, 40) for _ in range(60)), 308: "#$% | " * 40, 309: "line of text\n" * 12 + sentence(rng, 30)}
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en" if k % 3 else None, "src0" if k % 2 else "src1", 1, "a", "b", "c") for k, t in texts.items()]
    rows += [(None, "text without an id " * 5, "en", "src0", 1, "a", "b", "c"), rows[3]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_near_duplicates_match_all_pairs(docs, texts, empty):
    got = minhash.near_duplicates(docs, width=2, percent=80).collect()
    sets = {}
    for k, t in texts.items():
        w = words_of(t)
        sets[k] = {tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(texts) + 2 and set(by) == set(texts)
    for k in texts:
        assert (by[k].component_id, by[k].n_shingles, by[k].kept) == (find(k), len(sets[k]), find(k) == k)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert sum(find(k) != k for k in texts) >= 10
    assert minhash.near_duplicates(empty).count() == 0


def test_signature_estimate_follows_similarity():
    rng = np.random.default_rng(1)
    for j in (0.5, 0.8, 0.95):
        n = 4000
        both = int(2 * n * j / (1 + j))
        u = rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64)
        a, b = (minhash.minima(np.sort(x), minhash.K, minhash.FINE) for x in (u[:n], u[n - both:]))
        same = ((a ^ b) & 3 == 0).mean()
        assert abs((same - 0.25) / 0.75 - j) < 0.08
        assert ((a == b).mean() - j) < 0.08


def test_small_sets_at_the_threshold_are_linked(spark):
    rng = random.Random(21)
    rows = []
    for k in range(400):          # two-word shingles: 4 of 5, 8 of 10, and 12 of 15 by leaving out the last words
        w = [f"w{rng.randrange(10**9)}" for _ in range((6, 11, 16)[k % 3])]
        rows += [(k, " ".join(w)), (1000 + k, " ".join(w[:-(len(w) - 1) // 5]))]
    rows += [(5000 + k, " ".join(f"w{rng.randrange(10**9)}" for _ in range(6))) for k in range(20)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width=2, percent=80).collect()}
    sets = {k: {tuple(t.split()[i:i + 2]) for i in range(len(t.split()) - 1)} for k, t in rows}
    linked = {max(a, b): min(a, b) for a, b in itertools.combinations(sets, 2)
              if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(linked) == 400 and got == {k: linked.get(k, k) for k in sets}


def test_masks_find_every_stretch_of_eleven_in_thirteen():
    for span in (11, 12, 13):
        for bad in itertools.combinations(range(1, span - 1), span - 11):
            assert any(not set(bad) & {o + p for p in m} for m in decontaminate.MASKS for o in range(span - m[-1]))


def test_decontamination_matches_brute_force(spark, docs, texts, empty):
    w = texts[5].split(" ")
    changed = w[2:30]
    changed[7] = changed[15] = "other"
    items = [(1, " ".join(changed)), (2, " ".join(w[40:47])), (3, "two words"), (4, None), (None, texts[6]), (5, texts[200][-90:]),
             (5, texts[9]), (6, "nothing like it at all " * 4)]
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = defaultdict(set)
    for (k, t), (i, x) in itertools.product(texts.items(), items):
        a, b = words_of(t), words_of(x)
        if i is None or len(b) < 5:
            continue
        need, span = (11, 13) if len(b) >= 11 else (len(b), len(b))
        for d in range(-len(b), len(a)):
            q = [j for j in range(len(b)) if 0 <= j + d < len(a) and a[j + d] == b[j]]
            for s in range(len(q) - need + 1):
                if q[s + need - 1] - q[s] < span:
                    want[k, i] |= {(j, j + d) for j in q[s:s + need]}
    have = {(r.doc_id, r.item_id): (r.n_matched, r.first_word, r.last_word) for r in got}
    assert have == {k: (len({j for j, _ in v}), min(p for _, p in v), max(p for _, p in v)) for k, v in want.items()}
    assert (5, 1) in have and (5, 2) in have
    assert decontaminate.contaminated(docs, empty.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert decontaminate.contaminated(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_cuts_resist_insertions():
    rng = np.random.default_rng(3)
    a = rng.integers(97, 123, 20_000).astype(np.uint8)
    b = np.concatenate([a[:5000], rng.integers(97, 123, 7).astype(np.uint8), a[5000:]])
    ca, cb = set(chunks.bounds(a)), {x - 7 for x in chunks.bounds(b) if x > 5100}
    assert cb and cb <= ca
    assert list(chunks.bounds(np.full(1000, 97, np.uint8))) == [0, 256, 512, 768, 1000]
    assert list(chunks.bounds(np.zeros(0, np.uint8))) == [0]


def test_repeated_spans_are_equal_and_complete(docs, texts, empty):
    spans = chunks.repeated_spans(docs).collect()
    raw = {k: (t or "").encode() for k, t in texts.items()}
    covered = defaultdict(list)
    for s in spans:
        a = raw[s.doc_id][s.start:s.end]
        assert a == raw[s.first_doc_id][s.first_start:s.first_start + len(a)] and (s.first_doc_id, s.first_start) < (s.doc_id, s.start)
        assert s.n_words >= 50
        covered[s.doc_id].append((s.start, s.end))
    assert 200 not in covered and all(k in covered for k in (201, 202, 203, 300))
    first = {}
    for k in sorted(raw):          # every stretch of 51 words seen in an earlier text is covered
        at = [m.span() for m in re.finditer(BLANK.encode(), raw[k])]
        for i in range(len(at) - 50):
            g = raw[k][at[i][0]:at[i + 50][1]]
            if first.setdefault(g, k) != k:
                assert any(a <= at[i][0] and at[i + 50][1] <= b for a, b in covered[k]), k
    assert chunks.repeated_spans(empty).count() == 0


def test_repeats_of_short_words_are_found(spark):
    rng = random.Random(12)

    def short(n, longest):
        return " ".join("".join(rng.choice("abcdefghij0123") for _ in range(rng.randint(1, longest))) for _ in range(n))

    rows = []
    for k in range(60):
        passage = short(50, 1 + k % 3)
        rows += [(k, f"{short(30, 3)} {passage} {short(20, 3)}"), (1000 + k, f"{short(9 + k, 3)} {passage} {short(15, 3)}")]
    rows += [(2000, "0 1 " * 300), (2001, "x" * 90 + " 0 1" * 200)]          # periods of a few bytes
    raw = {k: t.encode() for k, t in rows}
    covered, first = defaultdict(set), set()
    for s in chunks.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        assert raw[s.doc_id][s.start:s.end] == raw[s.first_doc_id][s.first_start:s.first_start + s.end - s.start] and s.n_words >= 50
        covered[s.doc_id] |= set(range(s.start, s.end))
    for k in sorted(raw):          # all stretches of 50 whole words, repeats inside one text as well
        at = [m.span() for m in re.finditer(BLANK.encode(), raw[k])]
        for i in range(len(at) - 49):
            g = raw[k][at[i][0]:at[i + 49][1]]
            assert g not in first or set(range(at[i][0], at[i + 49][1])) <= covered[k], k
            first.add(g)
    assert all(covered[1000 + k] and k not in covered for k in range(60)) and covered[2000] and covered[2001]


def test_repeats_made_of_pieces_of_earlier_texts_are_found(spark):
    rng = random.Random(31)
    rows, passages = [], {}
    for k in range(0, 800, 100):
        w = sentence(rng, 60).split(" ")
        passages[k] = " ".join(w).encode()
        rows += [(k + 1, " ".join([sentence(rng, 20), *w[:45], sentence(rng, 20)])), (k + 2, " ".join([sentence(rng, 25), *w[15:], sentence(rng, 9)])),
                 (k + 5, " ".join([sentence(rng, 30), *w, sentence(rng, 10)])), (k + 9, " ".join([sentence(rng, 12), *w, sentence(rng, 30)]))]
    raw = {k: t.encode() for k, t in rows}
    got = chunks.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(k + 9, k + 5) for k in passages}
    for k, passage in passages.items():
        at = raw[k + 9].index(passage)
        assert any(r.doc_id == k + 9 and r.start <= at and at + len(passage) <= r.end for r in got)


def test_removing_spans_keeps_rows_columns_and_one_copy(docs, texts):
    out = chunks.remove_spans(docs, chunks.repeated_spans(docs))
    assert out.columns == docs.columns and out.count() == docs.count()
    by = {r.doc_id: r.text for r in out.collect()}
    passage = texts[200].split("\n")[1]
    assert passage in by[200] and all(passage not in by[k] for k in (201, 202, 203))
    assert by[301] is None and by[11] == texts[11] and by[302] == ""
    assert chunks.without("aéb".encode(), [(2, 3)]) == "aéb" and chunks.without("aéb".encode(), [(1, 3)]) == "ab"


@pytest.fixture(scope="module")
def vocabulary():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    return path


def test_token_counts_equal_the_library(docs, texts, empty, vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    got = {r.doc_id: r for r in tokens.token_counts(docs, vocabulary).collect()}
    for k, t in texts.items():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (n, len((t or "").encode()), n > 1024)
    odd = ["<|endoftext|>a<|endoftext|> b", "a\r\n\r\n  b\t\tc  ", "it's 12345 naïve 日本語テキスト 🙂🙂\u00a0x\u2028y", "\x1c\x85 \u3000a", " "]
    count = tokens.counter(tokens.read_vocabulary(vocabulary))
    assert [count.count(x) for x in odd] == [len(library.encode(x, add_special_tokens=False).ids) for x in odd]
    assert tokens.token_counts(empty, vocabulary).count() == 0


def test_spliced_counts_equal_whole_counts(vocabulary, texts):
    count = tokens.counter(tokens.read_vocabulary(vocabulary))
    rng = random.Random(8)
    for text in ("\n".join(t for t in texts.values() if t), "x" * 5000, "日本語" * 900, " " * 3000 + "a b" * 700,
                 "".join(rng.choice("ab '1\n\u00e9\u3000") for _ in range(6000)), "word " * 10 + "y" * 900 + " tail" * 50):
        whole = len(count.encoding.encode_ordinary(text))
        for chunk, overlap in ((400, 30), (257, 64), (1000, 3)):
            assert tokens.spliced_count(text.encode(), count.ends, chunk, overlap) == whole


def test_other_vocabularies_use_their_library(docs, texts):
    paths = pytest.importorskip("public_tokenizers").path
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=paths("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, paths("piece_bpe_32k.model")).collect()}
    assert all(got[k] == len(model.encode(t or "")) for k, t in texts.items())


def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(30):
        lengths = np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 9))), np.int64)
        counts = np.array([rng.randint(1, 9) for _ in lengths], np.int64)
        for k in (1, 2, 3, 4):
            got = packing.optimal_boundaries(lengths, counts, k)

            def waste(bounds):
                return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))

            best = min(waste((*some, lengths[-1])) for r in range(k) for some in itertools.combinations(lengths[:-1], r))
            assert len(got) <= k and got == sorted(got) and waste(got) == best
    assert packing.optimal_boundaries(np.zeros(0, np.int64), np.zeros(0, np.int64), 3) == []


def test_packing_places_every_document(docs, texts, empty):
    got = packing.packed(docs, buckets=3, token_budget=300).collect()
    assert len(got) == len(texts) + 2
    full = defaultdict(list)
    for r in got:
        if r.doc_id is not None:
            assert r.n_tokens == len(words_of(texts[r.doc_id]))
        if r.n_tokens == 0:
            assert (r.bucket, r.batch, r.slot, r.padding) == (None, None, None, 0)
        else:
            assert 0 <= r.padding == r.bucket_length - r.n_tokens
            full[r.bucket].append(r)
    assert len(full) == 3
    for rows in full.values():
        size = max(1, 300 // rows[0].bucket_length)
        rows.sort(key=lambda r: (r.batch, r.slot))
        assert [(r.batch, r.slot) for r in rows] == [divmod(i, size) for i in range(len(rows))]
        assert [(r.n_tokens, r.doc_id or -1) for r in rows] == sorted((r.n_tokens, r.doc_id or -1) for r in rows)
    assert packing.packed(empty).count() == 0


def test_packing_of_very_long_texts_matches_its_sql(spark):
    import duckdb

    from stratum.llm import oracle

    sizes = [3, 5, 5, 900, 65_537, 65_600, 65_791, 65_793, 65_793, 70_001, 70_100, 70_301, 131_073, 131_500, 131_585]
    rows = [(k, "a " * n) for k, n in enumerate(sizes)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(oracle.SQL["op1_length_buckets"])
    names = [c[0] for c in cur.description]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), buckets=8, token_budget=16384).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall()) and max(r.bucket_length for r in got) == 131_585


def test_quality_measures_match_brute_force(docs, texts, empty):
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    for k, t in texts.items():
        t = t or ""
        w, r = words_of(t, lower=False), got[k]
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        again = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(BLANK, x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert got[0].kept and got[7].kept and not got[308].kept
    assert quality.quality(empty).count() == 0


def test_quality_thresholds_adapt_and_merge(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(f"w{rng.randrange(10**5, 10**6)}" + ("#" if s == "noisy" else "") for _ in range(40)), "en", s)
            for k in range(600) for s in ("clean", "noisy")]
    rows.append((99999, " ".join(f"v{k}###" for k in range(40)), "en", "clean"))
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {(r.doc_id, r.top_symbols > 100): r.kept for r in got.collect()}
    assert kept[99999, False] is False and all(v for k, v in kept.items() if k[0] != 99999)
    values = spark.range(4000).select((F.col("id") * F.col("id")).alias("v"), F.lit("a").alias("k"), (F.col("id") % 2).alias("half"))
    whole = {(r.rule, r.bin): r.n for r in quality.sketches(values, ["k"], ["v"]).collect()}
    halves = quality.sketches(values, ["k", "half"], ["v"]).groupBy("rule", "bin").agg(F.sum("n").alias("n"))
    assert {(r.rule, r.bin): r.n for r in halves.collect()} == whole and len(whole) < 700
    assert all(v <= b <= v * 33 / 32 for v in (63, 64, 1000, 12345) for b in [
        spark.range(1).select(F.expr(quality.sketch_bin(f"{v}L"))).first()[0]])


def test_quality_filter_keeps_columns(docs):
    out = quality.filtered(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes and 0 < out.count() < docs.count()


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\1<s>[INST:x]</s>"), (2, 0, "assistant", "first"), (2, 1, None, None),
            (3, 1, "user", "b"), (3, 0, "system", "s"), (3, 2, "assistant", ""), (3, 2, "assistant", ""), (None, None, "odd]role", "é🙂"),
            (4, 0, "system", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rows", F.lit(1))
    out = formatted(turns)
    got = {r.conv_id: r for r in read_back(out).collect()}
    by = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda y: (y[1] is not None, y[1] or 0, y[2] or "", y[3] or "")):
        by[c].append((r or "", x or ""))
    assert set(got) == set(by)
    for c, turns_of in by.items():
        loss = "".join(x for r, x in turns_of if r == "assistant")
        assert got[c].n_turns == len(turns_of)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns_of).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: (r.valid, r.first_bad_turn) for c, r in got.items()} == {
        1: (True, None), 2: (False, 0), 3: (False, 3), None: (False, 0), 4: (False, 1)}
    for r in out.collect():
        assert r.formatted == "".join(s.text for s in r.segments) and [s.loss for s in r.segments[::3]] == [False] * (len(r.segments) // 3)
    t = Template()
    hard = spark.createDataFrame([(x,) for x in ("\\0\\1[", "<<]]\\\\", "")], "x string")
    assert all(r.a == r.x and "[" not in r.b and "<" not in r.b for r in hard.select(
        "x", escaped(F.col("x"), t).alias("b"), unescaped(escaped(F.col("x"), t), t).alias("a")).collect())
    assert formatted(turns.where("false")).count() == 0


URLS = ["http://a.example.com/en/1?x=1", "https://www.example.com/en/", "https://x.www.EXAMPLE.com/en/2#top", "http://b.net/es/5", "http://b.net/fr",
        "ftp://c.org", "no url", None, "", "http://d.net/de/9?a=1&b=2", "http://example.com", "http://netx/es/1", "x://net/fr/é?/en/"]


def test_url_rules_match_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[0]), (0, URLS[0])], "page_id long, url string").withColumn("host", F.lit("h"))
    got = urls.filter_urls(pages, boosting=urls.Boosting(trees=2, depth=2)).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        u = (URLS[r.page_id] if r.page_id is not None else URLS[0]) or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(x), x, v) for x, v in urls.RULES for d, _, p in [x.partition("/")]
                if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[1] if fits else None) and (not fits or r.verdict == max(fits)[2]) and r.verdict in ("allow", "block")
    assert urls.filter_urls(pages.where("false")).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages.where("page_id = 5")).collect()} <= {"allow", "block"}


def test_boosted_trees_learn_held_out_labels(spark):
    rows = spark.range(1200).select("id", F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".org/"), F.when(
        F.col("id") % 3 == 0, F.concat(F.lit("a/b/c/d/"), F.col("id"))).otherwise(F.concat(F.lit("p?q="), F.col("id")))).alias("url"))
    full = urls.with_suffixes(urls.lexical(urls.parts(rows, "id").withColumn("verdict", F.when(F.col("id") % 3 == 0, "block").otherwise("allow"))))
    full = full.withColumn("y", (F.col("verdict") == "block").cast("double"))
    score = urls.fit(full.where("id % 5 > 0"), urls.Boosting(trees=4, depth=2))
    right = full.where("id % 5 = 0").select(((score > 0) == (F.col("y") == 1)).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    assert right > 0.97
    e = urls.lexical(urls.parts(spark.createDataFrame([(1, "aabb"), (2, ""), (3, "aaaa")], "page_id long, url string"))).select("id", "entropy")
    assert {r.id: round(r.entropy, 9) for r in e.collect()} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_licence_paragraphs_found_and_clean_ones_left(spark, docs, texts, empty):
    notes = [(900, "Some first line\nReleased under the MIT License.\nmore words here", "MIT", 1),
             (901, "Licensed under the Apache License, Version 2.0.", "Apache-2.0", 0),
             (902, "x y z\n\n  All rights reserved.", "proprietary", 2),
             (903, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation", "GPL-3.0", 0)]
    more = spark.createDataFrame([(a, t) for a, t, _, _ in notes], "doc_id long, text string")
    got = licences.licence_paragraphs(docs.select("doc_id", "text").unionByName(more)).where("confirmed").collect()
    assert {(r.doc_id, r.family, r.paragraph) for r in got} == {(a, f, p) for a, _, f, p in notes}
    assert all(0.3 < r.probability <= 1 and r.similarity <= 1 for r in got)
    assert licences.licence_paragraphs(empty).count() == 0


def test_window_network_gradients_and_contexts():
    rng = np.random.default_rng(0)
    symbols, rows = rng.integers(0, lm.SYMBOLS, 40).astype(np.int32), np.array([0, 0, 1, 3, 30, 40, 40])
    around = lm.contexts(symbols, rows)
    for i in range(40):
        d = int(np.searchsorted(rows, i, "right")) - 1
        want = [symbols[i + k] if rows[d] <= i + k < rows[d + 1] else lm.SYMBOLS for k in (-2, -1, 1, 2)]
        assert list(around[:, i]) == want
    flat = rng.normal(0, 0.3, lm.SIZE)
    grad = np.zeros(lm.SIZE)
    lm.forward(lm.unflatten(flat), around, symbols, lm.unflatten(grad))
    for at in [*np.flatnonzero(grad)[rng.integers(0, np.count_nonzero(grad), 12)], lm.SIZE - 1]:
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-4
        down[at] -= 1e-4
        slope = -(lm.forward(lm.unflatten(up), around, symbols).mean() - lm.forward(lm.unflatten(down), around, symbols).mean()) / 2e-4
        assert math.isclose(slope, grad[at], rel_tol=2e-2, abs_tol=1e-3)
    p = lm.unflatten(flat)
    every = np.arange(lm.SYMBOLS, dtype=np.int32)
    total = np.exp(lm.forward(p, np.repeat(around[:, 5:6], lm.SYMBOLS, axis=1), every).astype(float)).sum()
    assert abs(total - 1) < 1e-3


def test_pseudo_likelihood_prefers_the_corpus_order(spark, empty):
    rng = random.Random(1)
    line = "the quick brown fox jumps over a lazy dog and then sleeps all day long".split()
    rows = [(k, " ".join(line[i % len(line)] for i in range(s, s + 300))) for k in range(60) for s in [rng.randrange(15)]]
    mixed = [(1000 + k, " ".join(rng.sample(t.split(), 300))) for k, (_, t) in enumerate(rows[:3])]
    docs = spark.createDataFrame([*rows, *mixed, (2000, None), (2001, " "), (None, "the quick")], "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in lm.pseudo_likelihood(docs, rounds=3).collect()}
    assert len(got) == 66 and got[0].n_tokens == 300 and math.isclose(got[0].mean_log_likelihood * 300, got[0].log_likelihood)
    assert (got[2000].n_tokens, got[2000].log_likelihood, got[2000].mean_log_likelihood) == (0, 0.0, None) and got[2001].n_tokens == 0
    assert min(got[k].mean_log_likelihood for k in range(60)) > max(got[1000 + k].mean_log_likelihood for k in range(3))
    assert lm.pseudo_likelihood(empty).count() == 0
