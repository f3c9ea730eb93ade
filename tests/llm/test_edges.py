"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import gzip
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import contained, lines, near_documents
from tierwarden.llm import (byte_bpe, chat, circulant_minhash, decontamination, embedding_dedup, labels, line_dedup, quality, shingles,
                            storage, toxicity, url_filter, warc)

DOCS = "doc_id long, text string, lang string, n_lines int, score string, component_id string, ids int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "x", "y", 2) for i, t in rows], DOCS)


# ---- chat

def test_chat_parts_and_escapes(spark):
    part = lambda kind, **k: {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | k
    rows = [(1, 0, "user", [part("text", text="a <|end|>\n [INST] &lt; "), part("image", ref="i.png", width=57, height=28), part("text", text="b")]),
            (1, 1, "assistant", [part("text", text="yes"), part("audio", ref="s.wav", seconds=1.5)]),
            (1, 2, "assistant", None), (1, 3, None, [part("document", ref="d.pdf", pages=2), part("video", ref="v")]),
            (None, None, "user|\n", [part("text", text=None)]), (2, 0, "assistant", []), (2, 0, "assistant", [])]
    out = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).collect()}
    one = out[1]
    turns = chat.read_back(one["formatted"])
    assert turns[0] == ("user", "a <|end|>\n [INST] &lt; <|image:0.1|>b") and turns[2] == ("assistant", "")
    assert "[INST]" not in one["formatted"] and one["n_turns"] == 4
    assert [(a["placeholder"], a["ref"], a["tokens"]) for a in one["attachments"]] == [
        ("<|image:0.1|>", "i.png", 3), ("<|audio:1.1|>", "s.wav", 38), ("<|document:3.0|>", "d.pdf", 2048), ("<|video:3.1|>", "v", 0)]
    assert one["expanded_tokens"] == 3 + 38 + 2048
    assert chat.loss_text(one["formatted"], one["loss"]) == "yes<|audio:1.1|>"
    assert chat.read_back(out[None]["formatted"]) == [("user|\n", "")] and out[2]["n_turns"] == 2
    empty = spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    assert chat.format_chats(empty).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet=st.sampled_from("&<[|\nltampbr;é"), max_size=30))
def test_escapes_are_reversible(text):
    for escapes in (chat.ESCAPES, chat.ROLE_ESCAPES):
        out = text
        for a, b in escapes:
            out = out.replace(a, b)
        assert chat.unescape(out, escapes) == text and "<" not in out


# ---- urls

def test_url_rules(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("A.net", "/x", "block"), (None, "/", "block"),
                                   ("a.net", "/x", "allow"), ("b.org", None, "block"), ("c.org", "/p", None)], "host string, path string, verdict string")
    want = {"http://example.net/en/1": ("example.net/en/", "allow"), "http://EXAMPLE.net/de": ("net/", "block"), "http://example.net": (None, "allow"),
            "http://q.a.NET/xyz?a": ("a.net/x", "block"), "http://b.org?x": ("b.org", "block"), "http://xb.org/": (None, "allow"),
            "no url": (None, "allow"), "": (None, "allow"), "x://y://net/": (None, "allow"), "http://net/#f": ("net/", "block"), None: (None, "allow"),
            "http://c.org/p": (None, "allow")}
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate([*want, "http://net/#f"])], "page_id int, url string, host string")
    out = url_filter.judge(df, rules)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert len(rows) == len(want) + 1
    for r in rows:
        assert (r["rule"], r["verdict"]) == want[r["url"]], r
    by = {r["url"]: (r["host"], r["path"]) for r in rows}
    assert by["http://q.a.NET/xyz?a"] == ("q.a.net", "/xyz") and by[None] == ("", "") and by["x://y://net/"] == ("y:", "//net/")
    assert url_filter.judge(df.limit(0), rules).count() == 0
    assert url_filter.judge(df, rules.limit(0)).filter("verdict = 'allow' and rule is null").count() == len(want) + 1


def test_long_urls_and_hosts(spark):
    """Many labels and segments, alone and together; rules at several depths of one host."""
    rules = [("net", "/", "block"), ("x.net", "/a/b/", "allow"), ("x.net", "/a/b/c", "block"), ("deep.org", "/s" * 300 + "/", "block"), ("l.l", "", "block")]
    urls = {"http://" + "l." * 200 + "x.net/a/b/" + "s/" * 2000: ("x.net/a/b/", "allow"), "http://x.net/a/b/cd": ("x.net/a/b/c", "block"),
            "http://x.net" + "/s" * 5000: ("net/", "block"), "http://deep.org" + "/s" * 5000: ("deep.org" + "/s" * 300 + "/", "block"),
            "http://deep.org" + "/s" * 300: (None, "allow"), "http://" + "l." * 3000 + "l": ("l.l", "block"), "http://x.net/a/b": ("net/", "block"),
            "http://" + "y" * 10000 + ".net?" + "z/" * 5000: (None, "allow")}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = url_filter.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert {r["url"]: (r["rule"], r["verdict"]) for r in got} == urls


# ---- WARC

def test_warc_round_trip(spark, tmp_path):
    big = "".join(random.Random(1).choices("abcdefgh\n<é", k=1 << 24))
    rows = [(3, "http://a/", "x"), (1, "http://b/ä\r\n", "x"), (2, None, "x"), (2, None, "x"), (5, "u", None), (4, "u", ""), (None, "n", "only"),
            (None, "n", "x"), (9, "big", big)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, body string, digest int")
    warc.write_archives(df, str(tmp_path / "a"), records_per_file=2)
    got = warc.read_archives(spark, str(tmp_path / "a"), chunk=1000).collect()
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    by = {(r["page_id"], r["url"]): r for r in got}
    assert (by[1, "http://b/ä\r\n"]["record_type"], by[1, "http://b/ä\r\n"]["refers_to"]) == ("response", None)
    for k in ((3, "http://a/"), (2, None), (None, "n")):
        if k != (None, "n"):
            assert (by[k]["record_type"], by[k]["refers_to"], by[k]["payload_bytes"], by[k]["payload"]) == ("revisit", 1, 1, None)
    assert by[4, "u"]["record_type"] == "response" and by[5, "u"]["refers_to"] == 4 and by[4, "u"]["payload_digest"] == warc.base32_sha1(b"")
    assert by[9, "big"]["payload"].decode() == big
    members = 0
    for path in (tmp_path / "a").glob("part-*"):      # plain concatenated gzip, a member for each record
        assert not path.stat().st_size or gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")
        members += path.read_bytes().count(warc.MEMBER)
    assert members == len(rows)
    warc.write_archives(df, str(tmp_path / "b"), min_revisit=2)
    assert warc.read_archives(spark, str(tmp_path / "b")).filter("record_type = 'revisit'").count() == 0
    warc.write_archives(df.limit(0), str(tmp_path / "c"))
    assert warc.read_archives(spark, str(tmp_path / "c")).count() == 0


def test_warc_reader_notices_damage():
    member = warc.to_member("1", None, b"abc", warc.base32_sha1(b"abc"), None, "2000-01-01T00:00:00Z")
    assert [r.verified for r in warc.Reader().feed(member)] == [True]
    changed = gzip.compress(gzip.decompress(member).replace(b"abc\r\n", b"abd\r\n"))
    assert [r.verified for r in warc.Reader().feed(changed)] == [False]
    with pytest.raises(ValueError):
        list(warc.Reader().feed(gzip.compress(gzip.decompress(member)[:-3])))
    for end in range(1, len(member) * 2):      # cut anywhere but between members
        reader = warc.Reader()
        got = list(reader.feed((member * 2)[:end]))
        assert len(got) == end // len(member)
        if end % len(member):
            with pytest.raises(ValueError):
                reader.close()
        else:
            reader.close()


def test_truncated_and_foreign_archives(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://a/{i}", f"text {i} " * (i % 40)) for i in range(400)], "page_id long, url string, html string")
    warc.write_archives(df.coalesce(1), str(tmp_path / "a"), records_per_file=250)
    files = sorted(p for p in (tmp_path / "a").glob("part-*"))
    assert len(files) == 2
    data = files[0].read_bytes()
    assert data.startswith(warc.MEMBER) and data.count(warc.MEMBER) == 250
    both = [warc.read_archives(spark, str(tmp_path / "a"), whole=w) for w in (False, True)]
    assert both[0].count() == 400 and both[0].exceptAll(both[1]).count() == 0
    for i, cut in enumerate((len(data) - 1, len(data) - 20, data.index(warc.MEMBER, 10) + 1, data.index(warc.MEMBER, 10) + 12)):
        (tmp_path / f"cut{i}").mkdir()
        (tmp_path / f"cut{i}" / "a").write_bytes(data[:cut])
        (tmp_path / f"cut{i}" / "b").write_bytes(files[1].read_bytes())
        for w in (False, True):
            with pytest.raises(Exception, match="ends inside|incorrect|invalid|not a WARC|length is"):
                warc.read_archives(spark, str(tmp_path / f"cut{i}"), whole=w).count()
    # another writer's members: other header bytes, many records in one archive
    (tmp_path / "foreign").mkdir()
    members = [gzip.compress(gzip.decompress(warc.MEMBER + m), 9) for m in data.split(warc.MEMBER)[1:]]
    (tmp_path / "foreign" / "x.warc.gz").write_bytes(b"".join(members))
    assert warc.read_archives(spark, str(tmp_path / "foreign"), whole=True).filter("verified").count() == 250


# ---- vectors

@pytest.mark.parametrize("tile", [1000, 7])
def test_vectors_against_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 19))
    rows = [(i, (centres[i % 12] + rng.normal(size=19) * rng.choice([0.02, 0.2, 0.35])).tolist(), int(i % 3)) for i in range(240)]
    rows += [(300 + i, rows[5][1], rows[5][2]) for i in range(20)] + [(400, rows[5][1], None), (401, None, 1), (402, [0.0] * 19, 1),
             (403, [float("nan")] * 19, 1), (404, [None] * 19, 1), (405, [], 1), (406, [1.0, 2.0], 1), (407, [-1.0, 2.0], 1), (408, [2.0, 4.0], 1),
             (409, [float("inf")] * 19, 1), (410, [x * 1e200 for x in rows[5][1]], rows[5][2]), (None, [9.0, 1.0], 0), (411, [0.0, 3.0], 0), (412, [-0.0, 3.0], 0)]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, embedding array<double>, label int, n_links int, name string")
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df).collect()}
    assert len(got) == len(rows)

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = [unit(r[1]) for r in rows]
    links = {r[0]: set() for r in rows}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and a[2] is not None and a[2] == b[2] and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) \
                    and units[i] @ units[j] >= 0.93:
                links[a[0]].add(b[0])
    for k, r in got.items():
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert r["n_links"] == len(links[k]), k
        if k is not None:
            assert r["component_id"] == min(x for x in seen if x is not None) and r["kept"] == (r["component_id"] == k)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


# ---- lines

LINE = "A line that many documents share, here"


def line_rows():
    return [(1, f"{LINE}\nown text of one\n\n  {LINE.upper()}\t"), (2, f"{LINE} \r\nxx"), (7, LINE), (3, "short\nshort"), (4, "short"), (5, "short"),
            (6, None), (8, ""), (9, "é" * 19 + "\n" + "é" * 20), (10, "é" * 20 + "\n" + "é" * 19), (11, "é" * 20 + "\n" + "é" * 19 + "\n"),
            (12, ("z" * 30 + "\n") * 3), (13, "z" * 30), (14, "\n\n\n"), (15, "\n".join(f"long line number {i} of a long text" for i in range(20000)))]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 3), (9, 2)])
def test_lines_against_brute_force(spark, batches, fanout):
    rows = line_rows()
    df = docs(spark, rows)
    out = line_dedup.dedup_lines(df, batches=batches, fanout=fanout)
    assert sorted(out.columns) == sorted([*df.columns, "n_dropped"])
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()} == lines(rows)


def test_lines_of_repeated_rows_null_ids_and_nothing(spark):
    rows = [(1, LINE), (1, LINE), (2, LINE), (None, "alone"), (None, LINE)]
    out = line_dedup.dedup_lines(docs(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == [(0, ""), (0, "alone"), (1, ""), (1, ""), (2, LINE)]
    assert line_dedup.dedup_lines(docs(spark, []).limit(0)).count() == 0
    assert line_dedup.dedup_lines(docs(spark, rows[:3])).filter("n_dropped > 0").count() == 0      # two documents only


def test_runs_in_any_order(spark):
    a, b = b"a" * 16, b"b" * 16
    batches = [[(1, a), (1, b)], [(9, a)], [(5, a), (4, b)], [(7, b), (2, a)]]
    for order in (batches, batches[::-1]):
        runs = line_dedup.LineRuns(spark, 3, 2)
        for batch in order:
            runs.add(spark.createDataFrame([(i, bytearray(k)) for i, k in batch], "id long, key binary"))
        assert {(bytes(r["key"]), r["keeper"]) for r in runs.repeated().collect()} == {(a, 9), (b, 7)}
        assert len(runs.levels) > 1


# ---- MinHash

def test_near_documents_against_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    base = [[rng.choice(words) for _ in range(rng.choice([30, 120]))] for _ in range(12)]
    rows = []
    for i in range(240):
        w = list(base[i % 12])
        for _ in range(rng.choice([0, 1, 2, 5, 9])):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((1000 - i, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "ONE  two"), (2005, "É é"), (2006, "é é"), (2007, "a b c"),
             (2008, " ".join(rng.choice(words) for _ in range(20000)))]
    for width, percent in ((3, 85), (5, 80)):
        got = circulant_minhash.near_duplicates(docs(spark, rows), width=width, percent=percent).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_documents(rows, width, percent)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_documents_chain_and_repeats(spark):
    w = [f"v{i}" for i in range(60)]
    chain = [(i, " ".join([*w[:60 - 2 * i], *(f"u{i}{j}" for j in range(2 * i))])) for i in range(8)]
    rows = [*chain, (None, chain[0][1]), (3, chain[3][1]), (3, chain[3][1])]
    got = circulant_minhash.near_duplicates(docs(spark, rows), width=3, percent=85).collect()
    want = near_documents(chain, 3, 85)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[0 if r["doc_id"] is None else r["doc_id"]]
    assert circulant_minhash.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_signature_is_circulant_and_estimates_jaccard():
    rng = np.random.default_rng(0)
    same = []
    for _ in range(40):
        a = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
        b = np.concatenate((a[:600], rng.integers(0, 2**63, 300).astype(np.uint64)))
        x, y = (circulant_minhash.signature(v, 160) for v in (a, b))
        same.append((x == y).mean())
    assert abs(np.mean(same) - 0.5) < 0.03 and np.std(same) < 0.06
    assert (circulant_minhash.signature(a[::-1], 160) == x).all()
    perm = circulant_minhash.rank(np.arange(1 << 16, dtype=np.uint32))
    assert len(np.unique(perm)) == 1 << 16


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2)]
    got = {r["node"]: r["component"] for r in storage.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert storage.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_run_hashes_depend_on_content_only():
    words = shingles.ascii_words("b a b a\tB  A x")
    found = shingles.shingle_hashes(words, 2)
    assert found[0] == found[2] == found[4] and found[1] == found[3] and len(set(found.tolist())) == 3
    assert len(shingles.shingle_hashes([], 2)) == 0 and len(shingles.shingle_hashes(words[:1], 2)) == 1
    assert len(shingles.shingle_hashes(words[:1], 2, short=False)) == 0


# ---- classifiers

GROUPS, TONES = ("blorgs", "quarks"), ("vile", "grand")


def paired_rows(n, seed):
    """Toxic is one tone about one group and the other tone about the other: no sum of weights tells them apart."""
    rng, words, out = random.Random(seed), [f"t{i}" for i in range(80)], []
    for i in range(n):
        g, t = rng.randrange(2), rng.randrange(2)
        w = [*(rng.choice(words) for _ in range(10)), GROUPS[g], TONES[t]]
        rng.shuffle(w)
        out.append((i, " ".join(w), int(g == t)))
    return out


def test_pairs_of_terms_that_are_harmless_alone(spark):
    rows = paired_rows(1500, 1)
    frame, known = docs(spark, [r[:2] for r in rows]), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(frame, known)
    fresh = paired_rows(300, 2)
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs(spark, [r[:2] for r in fresh]), model).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, _, y in fresh]) > 0.95


@pytest.mark.parametrize("method", [toxicity, quality])
def test_classifiers_without_rows_or_labels(spark, method):
    frame = docs(spark, [(1, None), (2, ""), (3, "some text"), (3, "some text"), (None, "x " * 50000)])
    for known in ([], [(1, 1), (2, 1), (3, 1)], [(None, 1), (3, None), (2, 0), (2, 0)], [(1, 0), (2, 1), (3, 1), (6, 0)]):
        model = method.train(frame, spark.createDataFrame(known, "doc_id long, toxic int"), label="toxic")
        out = method.scored(frame, model).collect()
        assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert method.scored(frame.limit(0), model).count() == 0


def test_training_rows_are_bounded_and_never_held_out(spark):
    frame = docs(spark, [(i, "t") for i in range(200)])
    known = spark.createDataFrame([(i, i % 2, i % 3) for i in range(300)] * 2, "doc_id long, toxic int, text int")
    rows = labels.training_rows(frame, known, "toxic", 30).collect()
    assert len(rows) == 60 and len({r["id"] for r in rows}) == 60 and all(r["label"] == r["id"] % 2 for r in rows)
    held = {r[0] for r in frame.filter(labels.held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert not held & {r["id"] for r in rows}


# ---- BPE

@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def check_bpe(spark, bpe, texts, words=byte_bpe.WORDS):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    frame = docs(spark, list(enumerate(texts)))
    out = bpe.encode(frame, "text", words).withColumn("bytes", bpe.decode(F.col("ids"))).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["ids"] == plain.encode_ordinary(r["text"] or ""), r["text"]
        assert bytes(r["bytes"]) == (r["text"] or "").encode()


def test_bpe_edges(spark, bpe):
    texts = [None, "", " ", "\n\n  x", "it's they'LL don't", "naïve\u00a0\u3000日本語 🙂🙂 \x00\x1f\x85", "a" * 300, "12345 ١٢٣ ½ Ⅷ", "<|endoftext|>",
             "ßẞ İ e\u0301 \ufeff", "tab\tx  \r\n ", "!!!???...", "word " * 3000, "\u200b\u2028 z"]
    check_bpe(spark, bpe, texts)
    frame = docs(spark, list(enumerate(texts)))
    check_bpe(spark, bpe, texts, 3)
    assert 0 < bpe.word_table(frame, words=3).num_rows <= 3
    assert bpe.encode(frame.limit(0)).count() == 0


def test_every_token_is_made_by_its_merges(spark, bpe):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = [(rank, token.decode()) for token, rank in ranks.items() if token.decode(errors="replace").encode() == token]
    frame = spark.createDataFrame(whole, "rank int, piece string").repartition(8)
    assert bpe.folded(frame, "piece", "ids").filter("ids <> array(rank)").count() == 0 and len(whole) > 49000


def test_white_space_and_letters_of_all_planes(spark, bpe):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0 or c < 0x3100]
    check_bpe(spark, bpe, ["".join(f"a{c}b {c} 1{c}{c}" for c in chars[i:i + 500]) for i in range(0, len(chars), 500)])


def test_bpe_random_texts(spark, bpe):
    found = []

    @settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True, database=None)
    @given(st.text(alphabet=st.characters(exclude_categories=("Cs", "Cn", "Co")), max_size=25))
    def gather(text):
        found.append(text)
    gather()
    rng = random.Random(9)
    found += ["".join(rng.choices("the ingatione\n.,'s AB é", k=40)) for _ in range(100)]
    check_bpe(spark, bpe, found)


# ---- decontamination

def test_containment_against_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    items = [(j, " ".join(rng.choice(words) for _ in range(n))) for j, n in enumerate([1, 2, 4, 5, 6, 9, 20, 33, 64, 200])]
    items += [(50, None), (51, " .,! "), (52, items[6][1]), (53, "É " * 7)]
    texts = []
    for i in range(150):
        body = [rng.choice(words) for _ in range(rng.choice([0, 10, 400, 4000]))]
        part = (items[i % 10][1] or "").split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            part[rng.randrange(len(part))] = "changed"
        cut = rng.randrange(len(body) + 1)
        texts.append((i, ", ".join([*body[:cut], *part, *body[cut:]]).upper()))
    texts += [(500, None), (501, ""), (502, "é É é é é é é é")]
    frame = docs(spark, texts)
    known = spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, n_item string")
    got = decontamination.contaminated(frame, known).collect()
    assert {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in got} == contained(texts, items) and len(got) > 100
    kept = decontamination.decontaminate(frame, known)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in texts} - {i for i, _ in contained(texts, items)}


def test_containment_of_repeats_and_nothing(spark):
    item = "one two three four five six seven"
    frame = docs(spark, [(1, item), (1, item), (None, item), (2, "x")])
    known = spark.createDataFrame([(1, item), (1, item), (None, item)], "item_id long, text string")
    got = decontamination.contaminated(frame, known).collect()
    assert [(r["doc_id"], r["item_id"], r["containment"]) for r in got] == [(1, 1, 1.0)]
    assert decontamination.contaminated(frame, known.limit(0)).count() == 0 and decontamination.contaminated(frame.limit(0), known).count() == 0
    assert sorted(str(r["doc_id"]) for r in decontamination.decontaminate(frame, known).collect()) == ["2", "None"]


def test_the_sketch_of_a_size_partition_is_long_enough(spark):
    rows = [(n, 5, list(range(n))) for n in range(1, 70)]
    counts = decontamination.sketches(spark.createDataFrame(rows, "item_id long, width int, shingles array<long>"), 0.8).groupBy("item_id").count()
    for r in counts.collect():
        n = r["item_id"]
        assert r["count"] >= min(n, n - -(-8 * n // 10) + 1)
