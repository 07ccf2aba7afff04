"""Media, packing, pieces and page texts: round trips and slow versions."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import public_tokenizers

from meshwork.llm import html_extract, media, packing, pieces
from tests.conftest import SF


def docs_of(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_media_equals_a_slow_version(spark):
    texts = docs_of(spark)
    got = media.op2_media(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        body = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        wav = media.wav_header(len(body)) + body
        assert tuple(r)[1:] == (len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]), len(wav), hashlib.sha256(wav).hexdigest(), media.feature(body))


def test_chunks_follow_the_content():
    rng = random.Random(1)
    body = bytes(rng.choices(b"abcdefgh ijklmnop", k=120_000))
    ends = media.cuts(body)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(body) and sizes[:-1].min() >= media.SMALLEST and sizes.max() <= media.LARGEST
    h, want = 0, []
    for i, b in enumerate(body):  # the rolling form of the hash
        h = ((h << 1) + int(media._GEAR[b])) % 2**32
        if h >> (32 - media.AVERAGE_BITS) == 0:
            want.append(i + 1)
    assert set(ends[:-1]) <= set(want) | {a + media.LARGEST for a in [0, *ends]}
    shifted = media.cuts(b"some more bytes before" + body)
    chunks = lambda b, e: {b[x:y] for x, y in zip([0, *e], e, strict=False)}
    same = chunks(body, ends) & chunks(b"some more bytes before" + body, shifted)
    assert len(same) >= len(ends) - 3


def test_packing_equals_the_reference_tokenizer(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by: dict = {}
    rows = packing.op9_packing(spark, SF).collect()
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in docs_of(spark).items():
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"].bit_count() == 1 and r["length"] <= 1024 and r["offset"] == 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_ids_equal_the_file_s_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, library = packing.Tokenizer(path), Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = ["", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext |>", "x" * 50_000, " " * 50_000, "\n \t" * 9_000]
    texts += ["".join(rng.choices(["a", "it's", "B", " ", " ", "\n", "\t", "é", "1", "22", "!", "..", "\u00a0", "日", "'", "<|endoftext|>", "<|endof", "😀"], k=rng.randint(0, 14))) for _ in range(4000)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_buckets_hold_equal_lengths_and_do_not_depend_on_the_layout(spark):
    rows = [(i if i % 9 else None, " ".join(["word"] * (i % 40)) if i % 7 else None) for i in range(500)] + [(5, "again"), (5, "again"), (6, "w " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    for parts in (1, 5):
        got = packing.pack(docs.repartition(parts), shards=3).collect()
        assert len({r["sequence_id"] for r in got}) == len(got)
        batches: dict = {}
        for r in got:
            assert r["bucket"] == r["length"] == len(r["ids"]) // 4 and r["offset"] == 0 and r["sequence_id"] >> 56 == r["length"].bit_length() - 1 and 0 <= r["shard"] < 3
            batches.setdefault((r["bucket"], r["shard"], r["batch"]), []).append(r)
        assert all(sum(r["length"] for r in b) <= packing.BATCH_TOKENS for b in batches.values())
        seen.append(sorted((r["sequence_id"], r["doc_id"] or -1, r["start"], bytes(r["ids"]), r["batch"]) for r in got))
    assert seen[0] == seen[1]
    assert {r[2] for r in seen[0] if r[1] == 6} >= {0, 1024}


def test_pieces_equal_the_library():
    import sentencepiece

    path = pieces.model_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = pieces.Encoder(pieces.Vocabulary(path))
    rng = random.Random(7)
    texts = ["", " ", "  a  b\n\tc ﬁ Å é x", "aaaaaaaaaaaaaaaaaaaaaaa", "日本語 テスト 😀"] + ["".join(rng.choices("abcdeinrst  ,.é", k=rng.randint(1, 60))) for _ in range(1500)]
    got = encoder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == library.encode(texts, num_threads=1)
    assert [pieces.decode(x, encoder.v) for x in got] == texts


def test_unigram_table_equals_a_slow_viterbi():
    v = pieces.Vocabulary(pieces.model_path())
    v.unigram = True
    rng = random.Random(8)
    v.scores = {p: -rng.random() * 5 - 1 for p in v.ids}
    v.floor = min(v.scores.values()) - 10
    encoder = pieces.Encoder(v)
    words = {pieces.MARK + "".join(rng.choices("abcdeinrst", k=rng.randint(1, 12))) for _ in range(200)}
    encoder.learn(words)
    for w in words:
        best = [0.0] + [-1e9] * len(w)
        for i in range(1, len(w) + 1):
            for j in range(i):
                s = v.scores.get(w[j:i], v.floor if i - j == 1 else None)
                if s is not None:
                    best[i] = max(best[i], best[j] + s)
        ids = np.frombuffer(encoder.known[w], "<u4").tolist()
        assert abs(sum(v.scores[v.texts[k]] for k in ids) - best[-1]) < 1e-9


def test_pieces_round_trip(spark):
    got = pieces.op10_pieces(spark, SF).collect()
    assert len(got) == len(docs_of(spark)) and all(r["round_trip"] for r in got)


def slow_text(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def test_page_texts_equal_a_slow_version(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.op6_html_text(spark, SF).collect()}
    assert got == {i: (slow_text(p), len(slow_text(p))) for i, p in pages.items()}


def test_wrapper_finds_the_slot_without_semantic_tags(spark):
    page = lambda i: f'<html><body><div id="top"><a href=/>Home</a> <a href=/x>About us</a></div><div class="wrap"><div id="story"><h2>Title {i}</h2><p>{("body %d text " % i) * 20}</p><p>Share this with all your friends now</p></div><div id="right"><p>The same words on each page of this site</p></div></div><div class="comments"><p>reader {i} says no</p></div></body></html>'
    rows = [(i, f"http://h.example.org/{i}", page(i)) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == f"Title {i}\n\n" + ("body %d text " % i * 20).strip()


def test_frames_and_markup_are_left_out():
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav>menu</nav><main><article><header><h1>A &amp; B</h1></header>
    <p>one<br>two&nbsp;<b>three</b></p><ul><li>x<li>y</ul><form><input>send</form><script>var a = "<p>no</p>";</script><aside>see also</aside><div class="ad">buy</div><p>four <a href=#>five</a></p><table><tr><td>c1<td>c2</table></article></main>
    <div class="cookie-notice">cookies</div><section id="comments"><p>first!</p></section><footer>(c)</footer></body></html>"""
    assert html_extract.extract(page) == "A & B\n\none two three\n\nx\n\ny\n\nfour five\n\nc1\n\nc2"
