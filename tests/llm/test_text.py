"""Encoding, packing, scoring, quality, pages and conversations."""

import hashlib
import math
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakewarden.llm import cotraining, fertility, lexicon, lm_automaton, packing, page_text, reply_trees
from lakewarden.llm.bpe import word_bpe
from lakewarden.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE, tokenizer_path
from lakewarden.llm.registry import QUERIES, SQL
from tests.llm.conftest import SF_DIR, lower, words_of
from tests.oracle import compare, connect

PATH = tokenizer_path(WORD_BPE)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("words", [None, [], [b"one", b"two", b"it's", b"onerous", b"Two"]])
def test_codec(docs, rows, words):
    library = Tokenizer.from_file(PATH)
    outputs = ["n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]
    got = lexicon.encode_texts(docs, PATH, outputs, keep=["doc_id", "kept"], words=words).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.n_tokens, r.decoded, r.kept) == (ids, len(ids), decoded, "x")
        assert (r.ids_sha256, r.decoded_sha256) == (digest(" ".join(map(str, ids))), digest(decoded))


def test_decode_ids(spark):
    frame = spark.createDataFrame([([1, 320, 2],), (None,), ([],)], "ids array<int>")
    got = [r.decoded for r in lexicon.decode_ids(frame, PATH).collect()]
    assert got == [Tokenizer.from_file(PATH).decode([1, 320, 2], skip_special_tokens=False), None, ""]


def test_automaton_is_minimal_and_exact():
    words = {b"sing": b"\1\0\0\0", b"ring": b"\2\0\0\0", b"rings": b"\3\0\0\0\4\0\0\0", b"s": b""}
    built = lexicon.Automaton.build(words)
    asked = [*words, b"", b"ri", b"ringss", b"x" * 100]
    places = built.find(asked).tolist()
    assert [built.output(p) if p >= 0 else None for p in places] == [*words.values(), None, None, None, None]
    assert len(built.final) - 1 < sum(map(len, words))  # shared ends


def test_codec_of_nothing(none):
    assert lexicon.encode_texts(none, PATH, ["n_tokens"], keep=["doc_id"]).count() == 0


@pytest.mark.parametrize("rows_per_task", [2, 1_000_000])
def test_packing(docs, rows, rows_per_task):
    library = Tokenizer.from_file(PATH)
    pieces = packing.pack(packing.token_pieces(docs, PATH, 64), 64, rows_per_task).toPandas()
    wanted = Counter()
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 64)):
            some = np.array(ids[at : at + 64], "<u4")
            wanted[(-1 if r[0] is None else r[0], n, at, len(some), zlib.crc32(some.tobytes()))] += 1
    columns = [pieces.doc_id.fillna(-1).astype(int), pieces.piece, pieces.start, pieces.length, pieces.ids_crc32]
    assert Counter(zip(*[c.tolist() for c in columns], strict=True)) == wanted
    ordered = pieces.sort_values(["sequence_id", "offset"])
    by = ordered.groupby("sequence_id").length
    assert (by.sum() <= 64).all()
    assert (ordered.offset == by.cumsum() - ordered.length).all()
    assert ordered.sequence_id.nunique() <= math.ceil(1.02 * pieces.length.sum() / 64) + 1


def test_packing_of_nothing(none):
    assert packing.pack_documents(none, PATH).count() == 0


def test_plan_places_every_length():
    rng = np.random.default_rng(4)
    histogram = np.zeros(101, np.int64)
    np.add.at(histogram, rng.integers(1, 101, 5000), 1)
    plan = packing.packing_plan(histogram, 100)
    assert set(plan.length) == set(np.flatnonzero(histogram))


@pytest.mark.parametrize(("order", "chunk_bytes"), [(2, 16 << 20), (3, 4000)])
def test_scores(docs, rows, order, chunk_bytes, monkeypatch):
    monkeypatch.setattr(lm_automaton, "SHARD_ENTRIES", 5000)
    texts = [(r[0], [*words_of(lower(r[1])), " end"]) for r in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    train = [t for (_, t), h in zip(texts, held, strict=True) if not h]
    seen = [Counter() for _ in range(4)]
    for t in train:
        full = [" start", *t]
        for k in range(1, order + 1):
            seen[k].update(tuple(full[i - k + 1 : i + 1]) for i in range(1, len(full)) if i - k + 1 >= 0)
    total, kinds = sum(seen[1].values()), len(seen[1])
    wanted = Counter()
    for (i, t), h in zip(texts, held, strict=True):
        full, base, score = [" start", *t], 0.0, 0.0
        for j in range(1, len(full)):
            p = (seen[1][(full[j],)] + 1) / (total + kinds + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                if j - k + 1 >= 0:
                    context = tuple(full[j - k + 1 : j])
                    before = len(train) if context == (" start",) else seen[k - 1][context]
                    p = (seen[k][(*context, full[j])] + lm_automaton.MASS * p) / (before + lm_automaton.MASS)
            score += math.log10(p)
        wanted[i, h, len(t), sum(seen[1][(w,)] > 0 for w in t), total, round(base, 6), round(score, 6)] += 1
    got = lm_automaton.score_texts(docs, order, chunk_bytes=chunk_bytes).collect()
    assert Counter((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in got) == wanted


def test_equal_rows_go_to_many_chunks(spark, monkeypatch):
    made = []
    settled = lm_automaton.settled
    monkeypatch.setattr(lm_automaton, "settled", lambda df: made.append(settled(df)) or made[-1])
    text = "all of these rows are one and the same"
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10_000))))
    got = lm_automaton.score_texts(docs, chunk_bytes=40_000).select("n_tokens", "train_tokens", "score").distinct().collect()
    assert [(r.n_tokens, r.train_tokens) for r in got] == [(10, 100_000)]
    # The texts' own rows, one per chunk.
    sizes = [len(lm_automaton.Grams.from_bytes(r.counts, 1).ids) for r in made[0].filter("k = -1").collect()]
    assert sum(sizes) == 10_000 and len(sizes) >= 8 and max(sizes) < 1_400


def test_probabilities_of_every_state_sum_to_one():
    """Arcs and failure arcs of the automaton: what a state gives to all words, seen and unseen, adds up to one."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words, size=rng.integers(0, 15))) for _ in range(60)]
    grams = lm_automaton.Grams.of_texts([None] * 60, [t.encode() for t in texts], 3)
    counts = [grams.training_counts(k) for k in range(3)]
    total, kinds = int(counts[0].sum()), int((counts[0] > 0).sum())
    built = lm_automaton.Automaton(grams, counts, total, kinds, 60)
    every = np.append(np.arange(len(counts[0])), len(counts[0]))  # and one word without an arc
    for state in range(len(built.fail)):
        logs, after = built.step(np.full(len(every), state), every)
        assert abs((10**logs).sum() - 1) < 1e-9
        assert (after < len(built.fail)).all()
    # Failure arcs lead to shorter contexts, and at last to the root.
    assert built.fail[0] == lm_automaton.ROOT and (built.fail <= np.maximum(0, np.arange(len(built.fail)) - 1)).all()
    ended = [int((grams.tokens[first] == lm_automaton.END).sum()) for first in grams.first]
    assert len(built.fail) == 2 + sum(int((c > 0).sum()) - e for c, e in zip(counts[:2], ended[:2], strict=True))


def test_scores_of_nothing(none):
    assert lm_automaton.score_texts(none).count() == 0


def test_held_out_texts_score_above_the_base(spark):
    got = QUERIES["op6_backoff_automaton"](spark, SF_DIR).filter("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_fertility(spark, docs, rows):
    got = fertility.judge(docs, tokenizer_path(PIECE_BPE), tokenizer_path(BYTE_BPE)).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    for r in got:
        text, words = texts[r.doc_id], words_of(texts[r.doc_id])
        often = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = [False] * len(words)
        for i in range(len(words) - 2):
            if often[tuple(words[i : i + 3])] > 1:
                covered[i : i + 3] = [True] * 3
        lines = [line for line in text.split("\n") if words_of(line)]
        plain = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain
        assert r.base_failed == (len(words) < 50 or 100 * sum(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert fertility.judge(docs.limit(0), tokenizer_path(PIECE_BPE), tokenizer_path(BYTE_BPE)).count() == 0


def plain_measures(text, pieces, ranks):
    """The token measures of a text, word by word with the libraries."""
    words = words_of(text)
    if not words:
        return None
    chars = sum(map(len, words))
    ids = [i for w in words for i in pieces.encode(w)]
    counts = Counter(ids)
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values()) / max(1.0, math.log2(len(ids)))
    byte_tokens = sum(len(ranks.encode_ordinary(w)) for w in words)
    return chars / len(ids), chars / max(1, byte_tokens), sum(pieces.is_byte(i) for i in ids) / len(ids), entropy


def test_fertility_bands_and_verdict(spark):
    """Measures, bands and verdict of every document, from quartiles of sorted lists."""
    import base64

    import public_tokenizers
    import sentencepiece
    import tiktoken

    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    with open(tokenizer_path(BYTE_BPE), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    ranks = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows += [type(rows[0])(10_000 + i, "☃☄★ " * (40 + i), "en") for i in range(30)]  # characters no vocabulary holds
    frame = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in fertility.judge(frame, tokenizer_path(PIECE_BPE), tokenizer_path(BYTE_BPE)).collect()}
    measures = {r[0]: plain_measures(r[1] or "", pieces, ranks) for r in rows}
    by_language = {}
    for i, _, lang in map(tuple, rows):
        if not got[i].base_failed:
            by_language.setdefault(lang, []).append(measures[i])
    bands = {}
    for lang, found in by_language.items():
        for m, name in enumerate(fertility.MEASURES):
            values = sorted(f[m] for f in found)
            low, mid, high = (values[max(0, math.ceil(q * len(values)) - 1)] for q in (0.25, 0.5, 0.75))
            if name == "byte_share":
                bands[lang, m] = (0.0, high + max(fertility.BYTE_MARGIN, fertility.SPREAD * (high - low)))
            else:
                wide = max(fertility.SPREAD * (high - low), fertility.LEAST[name] * mid)
                bands[lang, m] = (mid - wide, mid + wide)
    rejected = 0
    for i, _, lang in map(tuple, rows):
        have = [getattr(got[i], name) for name in fertility.MEASURES]
        assert have == [None] * 4 if measures[i] is None else np.allclose(have, measures[i], rtol=1e-12, atol=1e-12)
        inside = measures[i] is not None and all(
            bands[lang, m][0] <= v <= bands[lang, m][1] for m, v in enumerate(measures[i]) if (lang, m) in bands
        )
        assert got[i].kept == (inside and not got[i].base_failed), (i, measures[i])
        rejected += not inside and not got[i].base_failed
    assert rejected > 0


def test_fertility_keeps_prose_and_rejects_symbols(spark):
    got = QUERIES["op3_tokeniser_fertility"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").toPandas()
    fit = got[~got.base_failed]
    assert fit[fit.quality == 1].kept.mean() > 0.98
    noisy = fit[fit.n_symbols > fit.n_words]
    assert len(noisy) and not noisy[noisy.quality == 0].kept.all()


def test_cotraining_on_other_labels(spark):
    """Accuracy on labels that the fit has not seen."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    known, asked = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    model = cotraining.fit(docs, known)
    got = cotraining.score_documents(docs, model, ["doc_id"]).join(asked, "doc_id").toPandas()
    assert (got.kept == (got.quality == 1)).mean() > 0.95
    assert got[got.quality == 1].kept.mean() > 0.97


def test_cotraining_rounds():
    """Which pool rows change hands in which round, and the scores, against the rounds written out."""
    rng = np.random.default_rng(4)
    widths = [len(r) for r in cotraining.RIDGES]
    truth = rng.integers(0, 2, 260)
    views = [rng.normal(size=(260, w)) for w in widths]
    for view, weight in zip(views, (1.2, 0.9), strict=True):
        view[:, :3] += weight * (2 * truth[:, None] - 1)
    known, pool = np.arange(60), np.arange(60, 260)
    labels = truth[known]
    model = cotraining.CoTrained([v[known] for v in views], labels, [v[pool] for v in views])

    aside = known % 4 == 3
    given = [[(views[k][i], float(truth[i])) for i in known if not aside[i]] for k in (0, 1)]
    left = list(range(200))

    def fit(k):
        x, y = map(np.array, zip(*given[k], strict=True))
        return cotraining.Logistic(x, y, cotraining.RIDGES[k])

    models, moved = [fit(0), fit(1)], 0
    for _ in range(cotraining.ROUNDS):
        for giver in (0, 1):
            p = {i: 1 / (1 + math.exp(-models[giver].logit(views[giver][pool[i]][None])[0])) for i in left}
            most = int(cotraining.SHARE * 200 / 2)
            sure = [i for i in sorted(left, key=lambda i: -p[i])[:most] if p[i] >= cotraining.SURE]
            sure += [i for i in sorted(left, key=lambda i: p[i])[:most] if p[i] <= 1 - cotraining.SURE]
            given[1 - giver] += [(views[1 - giver][pool[i]], float(p[i] > 0.5)) for i in sure]
            left = [i for i in left if i not in set(sure)]
            moved += len(sure)
        models = [fit(0), fit(1)]
    assert moved > 40
    for k in (0, 1):
        assert np.allclose(model.models[k].w, models[k].w, atol=1e-6)
    logits = [models[k].logit(views[k][known][aside])[:, None] for k in (0, 1)]
    calibrations = [cotraining.Logistic(x, labels[aside].astype(float), 0.1) for x in logits]
    both = np.column_stack([c.logit(x) for c, x in zip(calibrations, logits, strict=True)])
    combined = cotraining.Logistic(both, labels[aside].astype(float), 0.1)
    asked = [v[pool] for v in views]
    apart = np.column_stack([c.logit(m.logit(v)[:, None]) for c, m, v in zip(calibrations, models, asked, strict=True)])
    one, two, score = model.scores(*asked)
    assert np.allclose(one, 1 / (1 + np.exp(-apart[:, 0])), atol=1e-6) and np.allclose(two, 1 / (1 + np.exp(-apart[:, 1])), atol=1e-6)
    assert np.allclose(score, 1 / (1 + np.exp(-combined.logit(apart))), atol=1e-6)
    assert ((score >= 0.5) == (truth[pool] == 1)).mean() > 0.9


def test_logistic_solves_its_equation():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = (x @ [1.0, -2.0, 0.0, 0.5] + rng.normal(size=300) > 0).astype(float)
    model = cotraining.Logistic(x, y, 1.0)
    z = np.column_stack([(x - x.mean(0)) / (x.std(0) + 1e-6), np.ones(300)])
    p = 1 / (1 + np.exp(-z @ model.w))
    assert np.abs(z.T @ (y - p) - np.append(np.full(4, 1.0), 1e-3) * model.w).max() < 1e-8


def test_cotraining_edges(spark, docs, none):
    labels = spark.createDataFrame([(6, 1), (6, 1), (9, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = cotraining.score_documents(docs, cotraining.fit(docs, labels), ["doc_id", "lang"]).collect()
    assert len(got) == docs.count()
    assert all(r.kept and r.score == 1.0 for r in got)
    mixed = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    got = cotraining.score_documents(docs, cotraining.fit(docs, mixed), ["doc_id"]).collect()
    assert all(0 <= r.score <= 1 for r in got)
    assert cotraining.score_documents(none, cotraining.fit(none, labels.limit(0)), ["doc_id"]).count() == 0


def test_page_blocks():
    page = "<p>a &amp; b<br>c<p>d <b>e</b><script>var x='</p>';</script><!-- no --><ul><li>f<li>g</ul><div title='x>y'>h &lt;p&gt;</div>i<"
    assert [b.text for b in page_text.blocks_of(page)] == ["a & b c", "d e", "f", "g", "h <p>", "i<"]
    assert page_text.blocks_of("") == []
    assert [b.text for b in page_text.blocks_of("<div><p>" * 2000 + "deep")] == ["deep"]


def test_page_model_on_other_pages():
    model = page_text.default_model()
    pages = page_text.labelled_pages(150, seed=77)
    right = [model.decode(page_text.blocks_of(p)) == labels for p, labels in pages]
    assert np.mean(right) > 0.9


def test_pages(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><ul><li><a href='/'>home</a></li><li><a href='/x'>menu</a></li></ul></nav>"
        "<div class='cookie'><p>We use cookies.</p></div><article><h1>Title here</h1><p>First   part &eacute;.<br>More.</p><p>Of.</p>"
        "<form><label>Mail</label><button>Subscribe</button></form></article><aside><p>Related things</p></aside>"
        "<div id='comments'><div class='comment'><p>Nice one</p></div></div><footer>&copy; 2020 site</footer></body></html>"
    )
    frame = spark.createDataFrame([(1, "u", page, "t"), (2, None, None, "t"), (3, "u", "", "t")], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in page_text.extract_main_text(frame).collect()}
    assert got[1].text == "Title here\nFirst part é. More.\nOf."
    assert [(got[i].text, got[i].n_chars) for i in (2, 3)] == [("", 0), ("", 0)]
    assert page_text.extract_main_text(frame.limit(0)).count() == 0


class ArticleText(HTMLParser):
    """Text of the blocks of <article>, by the standard library's parser: every tag that isn't inline ends a block."""

    INLINE = {"a", "b", "i", "em", "strong", "span", "code", "small", "sup", "sub", "u", "br", "img"}

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts, self.blocks = 0, [], []
        self.feed(html)
        self.close()
        self.cut()

    def cut(self):
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        self.blocks += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attributes):
        if tag == "br":
            self.parts.append(" ")
        elif tag not in self.INLINE:
            self.cut()
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self.cut()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.parts.append(data)


def test_pages_of_the_table(spark):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = QUERIES["op5_crf_page_text"](spark, SF_DIR).collect()
    assert len(got) == len(html)
    for r in got:
        want = "\n".join(ArticleText(html[r.page_id] or "").blocks)
        assert (r.text, r.n_chars) == (want, len(want))


def test_long_and_repeated_pages(spark):
    """A very long page is read whole; equal rows give equal results."""
    words = " ".join(f"word{i}" for i in range(40_000))
    page = f"<html><body><nav><a href='/'>home</a></nav><article><h1>Long one</h1>{''.join(f'<p>{words}</p>' for _ in range(3))}</article></body></html>"
    frame = spark.createDataFrame([(1, "u", page)] * 3, "page_id long, url string, html string")
    got = page_text.extract_main_text(frame).collect()
    assert [r.text for r in got] == ["\n".join(["Long one", words, words, words])] * 3


def test_reply_trees_against_sql(spark):
    frame = QUERIES["op7_reply_trees"](spark, SF_DIR)
    assert compare(frame, connect(SF_DIR), SQL["op7_reply_trees"]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_reply_tree_branches(spark):
    odd = "hi \\ <| <\\| \\| x<"
    rows = [
        (1, 1, None, "user", odd, 0.0), (1, 2, 1, "assistant", "a\n", 1.0), (1, 3, 1, "assistant", "b", 2.0), (1, 4, 3, "us\ner", None, 0.0),
        (1, 5, 4, "assistant", "|", 0.5), (None, 1, None, None, "q", 0.0), (2, 9, 7, "assistant", "orphan", 0.0),
    ]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {(r.tree, r.leaf): r for r in reply_trees.read_back(reply_trees.format_trees(nodes)).collect()}
    assert [tuple(t) for t in got[1, 5].turns] == [("user", odd), ("assistant", "b"), ("us\ner", ""), ("assistant", "|")]
    assert (got[1, 5].rank, got[1, 5].loss_text, got[1, 2].rank, got[1, 2].loss_text) == (1, "b|", 2, "a\n")
    assert (got[None, 1].loss_text, got[2, 9].loss_text, len(got)) == ("", "orphan", 4)
    assert {(r.tree, r.leaf) for r in reply_trees.format_trees(nodes, best=1).collect()} == {(1, 5), (None, 1), (2, 9)}
    assert reply_trees.format_trees(nodes.limit(0)).count() == 0


def test_long_conversation_and_ties(spark):
    rows = [(1, i // 2, "user" if i % 3 else "assistant", f"t{i}") for i in range(70)] + [(None, None, None, None)] * 2
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.tree: r for r in reply_trees.read_back(reply_trees.format_trees(reply_trees.turns_as_trees(turns))).collect()}
    assert [tuple(t) for t in got[1].turns] == [(r[2], r[3]) for r in sorted(rows[:70], key=lambda r: r[1:])]
    assert [tuple(t) for t in got[None].turns] == [("", "")] * 2


def test_words_merge_like_the_library():
    bpe, library = word_bpe(PATH), Tokenizer.from_file(PATH)
    rng = np.random.default_rng(8)
    letters = list("aAbßΣσé́ıİ'sS'LL123½<|endoftext|>\u0085中😀ǅﬁ.,!?-_ǹŉ")
    words = sorted({"".join(rng.choice(letters, rng.integers(1, 90))) for _ in range(400)})
    words = [w.encode() for text in words for w in text.split() if w]
    for word, ids in zip(words, bpe.encode_new(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(word.decode(), add_special_tokens=False).ids
