"""WARC archives, token alignment and the prefix trie against brute force."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from brute import words
from pyspark.sql import functions as F
from tessera.llm import alignment, ordered, prefix_trie, warc
from tessera.llm.common import Scratch
from tessera.llm.queries import BYTE_MODEL, PIECE_MODEL, QUERIES
from tessera.llm.sentencepieces import read_model

BASE = "/root/testdata/sf0.001"
LONG = "<p>" + "long page " * 40_000 + "</p>"
COPY = "<p>" + "copied page " * 20 + "</p>"
PAGES = [(5, "http://a/5", COPY), (3, "http://a/3\r\nX: y", COPY), (9, None, COPY), (None, "http://a/n", COPY), (1, "http://b/é", None),
         (2, "http://b/2", ""), (4, "http://b/4", "short"), (6, "http://b/6", "short"), (7, "http://c", LONG), (8, "http://c", LONG),
         (10, "http://d", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 7\r\n\r\n" + "x" * 100), (None, "u", "nameless" * 30),
         (None, "u", "nameless" * 30), (11, "http://e", "é" * 50), (12, "http://e", "é" * 49), (12, "http://e", "é" * 49)]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h, "clash", 1, "x") for i, u, h in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, archive string, offset int, record_type string")


def archived_pages(rows):
    """(page_id, bytes, digest, type, refers_to), unordered."""
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for payload, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        for n, i in enumerate(ids):
            again = n > 0 and len(payload) >= 100
            out.append((i, len(payload), sha256(payload).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return out


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_archives(pages):
    got = warc.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert by_text(got) == by_text(archived_pages(PAGES))


def test_archive_of_no_pages(pages):
    assert warc.archived(pages.where("false")).collect() == []


def test_archives_hold_whole_records(spark, pages):
    """Payloads, addresses and lengths come back; revisits name their original."""
    scratch = Scratch(spark, "warc-test")
    warc.write_responses(pages, scratch.path("a"), date="2020-01-01T00:00:00Z")
    first = warc.read_records(spark, scratch.path("a"), payloads=True).collect()
    assert by_text((r["page_id"], bytes(r["payload"])) for r in first) == by_text((i, (h or "").encode()) for i, _, h in PAGES)
    assert {r["target_uri"] for r in first} >= {"http://a/3%20%20X:%20y", "http://b/é", ""} and len({r["record_id"] for r in first}) == len(PAGES)
    warc.write_deduplicated(spark, scratch.path("a"), scratch.path("b"), scratch)
    second = warc.read_records(spark, scratch.path("b"), payloads=True).collect()
    held = {r["record_id"]: r for r in second}
    assert len(held) == len(PAGES)
    for r in second:
        if r["record_type"] == "revisit":
            original = held[r["refers_to"]]
            assert original["record_type"] == "response" and original["payload_digest"] == r["payload_digest"] and not r["payload"]
    assert sum(len(r["payload"]) for r in second) < sum(len(r["payload"]) for r in first)


def test_archives_dedupe_again(spark, pages):
    """Revisits of an earlier run are resolved by their digest."""
    scratch = Scratch(spark, "warc-twice")
    warc.write_responses(pages, scratch.path("a"))
    warc.write_deduplicated(spark, scratch.path("a"), scratch.path("b"), scratch)
    warc.write_deduplicated(spark, scratch.path("b"), scratch.path("c"), Scratch(spark, "warc-again"))
    got = warc.resolved(spark, scratch.path("c"), scratch).select("page_id", "payload_bytes", "payload_digest", "record_type", "original").collect()
    assert by_text(got) == by_text(archived_pages(PAGES))


def test_broken_archives_fail(spark, pages):
    scratch = Scratch(spark, "warc-broken")
    record = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"
    spark.createDataFrame([(record,)], "value string").write.option("lineSep", "\r\n\r\n").text(scratch.path("cut"))
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(spark, scratch.path("cut")).collect()
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 5\r\n\r\nshort"
    spark.createDataFrame([(record,)], "value string").write.option("lineSep", "\r\n\r\n").text(scratch.path("digest"))
    with pytest.raises(Exception, match="another digest"):
        warc.read_records(spark, scratch.path("digest")).collect()


# --- alignment ---------------------------------------------------------------

@pytest.fixture(scope="module")
def models():
    return read_model(public_tokenizers.path(BYTE_MODEL)), read_model(public_tokenizers.path(PIECE_MODEL))


def tokens(models):
    """A plain function from a text to (A's ids, their ends, B's ids, their ends)."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_buffer(models[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=models[1])
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}

    def run(text):
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        p = [bytes(back[c] for c in a.id_to_token(i)) for i in x]
        q = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        want = (" " + text).encode()
        if b"".join(p) != want or b"".join(q) != want:
            return [], [], [], []
        return x, np.cumsum([len(t) for t in p]).tolist(), y, np.cumsum([len(t) for t in q]).tolist()

    return run


def brute_alignment(rows, models):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, sha, n_overlaps, n_shared)] in row order."""
    encode, docs, counts = tokens(models), [], Counter()
    for _, text in rows:
        x, ex, y, ey = encode(text) if text else ([], [], [], [])
        both = sorted(set(ex) & set(ey))
        group = lambda e: sum(c < e for c in both)
        gx, gy = Counter(map(group, ex)) if len(ex) < 3000 else None, Counter(map(group, ey)) if len(ex) < 3000 else None
        at, parts, i, j = 0, [], 0, 0
        for c in both:
            p, q = i, j
            while i < len(x) and ex[i] <= c:
                i += 1
            while j < len(y) and ey[j] <= c:
                j += 1
            parts.append(",".join(map(str, x[p:i])) + "|" + ",".join(map(str, y[q:j])))
        place = dict(zip(ey, y))
        links = [(a, place[e]) for a, e in zip(x, ex) if e in place]
        counts.update(links)
        overlaps = len(set(ex) | set(ey))
        shared = sum(n * gy[g] for g, n in gx.items()) if gx is not None else None
        docs.append((len(x), len(y), len(both), links, sha256(";".join(parts).encode()).hexdigest() if x else "", overlaps if x else 0, shared))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(na, nb, ng, len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), sha, over, shared)
            for na, nb, ng, links, sha, over, shared in docs]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_shared"]


def check_alignment(rows, got, models):
    want = brute_alignment(rows, models)
    seen = by_text((r["doc_id"], *(r[c] for c in COLUMNS[:8])) for r in got)
    assert seen == by_text((i, *w[:8]) for (i, _), w in zip(rows, want))
    shared = by_text((r["doc_id"], r["groups_sha256"], r["n_shared"]) for r in got)
    for (i, _), w in zip(rows, want):
        if w[8] is not None:
            assert repr((i, w[6], w[8])) in set(map(repr, shared))


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0}])
def test_alignment_of_odd_rows(odd_docs, odd_rows, models, options):
    check_alignment(odd_rows, alignment.alignments(odd_docs, *models, **options).collect(), models)


def test_alignment_of_odd_texts(spark, models):
    rows = list(enumerate([" ", "  a  b ", "a b", "x <|endoftext|> y", "<s> </s> <unk>", "naïve café 東京タワー 🏳️‍🌈 é́", "a\tb\nc\r\nd  e",
                           "y" * 3000, "don't we'll 1234 12a", "tail ", " head", "▁", "\x1c \x85 　 z"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_alignment(rows, alignment.alignments(docs, *models).collect(), models)


def test_alignment_query(spark, models):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "text").collect()]
    check_alignment(rows, QUERIES["op12_token_alignment"](spark, BASE).collect(), models)


def test_alignment_forgets_and_cuts(odd_docs, odd_rows, models, monkeypatch):
    """The same with a memo that is always full and pieces of few characters."""
    aligner = alignment.Aligner(*models)
    for text in (t for _, t in odd_rows if t and len(t) < 2000):
        whole, apart = alignment._Document(), alignment._Document()
        for document, size in ((whole, 1 << 20), (apart, 10)):
            for units in alignment.pieces_of(text, size):
                aligner.held = alignment.MEMO + 1
                alignment._add_all(aligner, [(document, units)])
        assert whole.spelt == apart.spelt
        if whole.spelt:
            assert (whole.counts == apart.counts).all() and whole.sha.hexdigest() == apart.sha.hexdigest()
            assert all((x == y).all() for x, y in zip(whole.merge(), apart.merge()))


def test_alignment_of_no_rows(no_docs, models):
    assert alignment.alignments(no_docs, *models).collect() == []


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_token_links(spark, models, kind):
    text = "The harbour's naïve café, 東京 1234 yyyyyyyyyyyyy"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "▁")], "doc_id long, text string")
    got = {(r["a_at"], r["b_at"], r["a_id"], r["b_id"]) for r in alignment.token_links(docs, *models, kind=kind).collect()}
    x, ex, y, ey = tokens(models)(text)
    both = sorted(set(ex) & set(ey))
    spans = lambda ends: list(zip([0, *ends], ends))
    group = lambda e: sum(c < e for c in both)
    related = (lambda p, q: p[0] < q[1] and q[0] < p[1]) if kind == "overlap" else (lambda p, q: group(p[1]) == group(q[1]))
    assert got == {(i, j, x[i], y[j]) for i, p in enumerate(spans(ex)) for j, q in enumerate(spans(ey)) if related(p, q)}


def test_row_products():
    """Against dense matrices, with empty rows and columns."""
    rng = np.random.default_rng(5)
    for n, m, k in ((1, 1, 1), (6, 4, 5), (30, 20, 25), (3, 50, 2)):
        a, b = rng.random((n, m)) < 0.2, rng.random((m, k)) < 0.2
        sparse = lambda d: alignment.CSR(np.concatenate([[0], np.cumsum(d.sum(axis=1))]), np.nonzero(d)[1], d.shape[1])
        i, j, v = alignment.row_products(sparse(a), sparse(b))
        dense = np.zeros((n, k), int)
        dense[i, j] = v
        assert (dense == a.astype(int) @ b.astype(int)).all()
        t = alignment.transpose(sparse(a))
        assert (np.concatenate([np.full(c, r) for r, c in enumerate(np.diff(t.indptr))]) == np.nonzero(a.T)[0]).all()
        assert (t.indices == np.nonzero(a.T)[1]).all()


# --- prefix trie ---------------------------------------------------------------

TURNS = [(c, t, role, text) for c in range(45) for t in range(c % 6) for role, text in
         [("user", "same start")] * (t == 0) + [(None if c % 3 == 0 else "a", f"turn {t} of {c % 4}")] * (t > 0)]
TURNS += [(100, None, "s", "null first"), (100, 1, "u", None), (100, 1, "u", "tie"), (100, 1, "u", "tie"), (100, 1, None, "tie"),
          (101, 1, "u", "own"), (119, 0, "u", "x"), (119, 1, "u", "y"), (137, 0, "u", "no base"), (-7, 0, "u", "minus"), (-20, 3, "u", "minus base"),
          (None, 0, "u", "nobody's"), (200, 0, "u", "word " * 30_000), (2**40, 0, "", ""), (2**40 + 1, 0, "", "")]


def md5(text):
    from hashlib import md5 as digest
    return digest(text.encode()).hexdigest()


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, role or "", md5(text or ""), text or ""))
    turns = {c: [(r, x) for *_, r, _, x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = (turns.get(base, [])[:h] + own[h:]) if True else None
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        leaves, saved = (0 if children[p] else 1), (len(members[p]) - 1) * (len(words(p[-1][1])) if p else 0)
        for q in children[p]:
            x, y = below(q)
            leaves, saved = leaves + x, saved + y
        return leaves, saved

    return [(min(m), len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), *below(p),
             sha256(",".join(str(c) for c in m if len(whole[c]) == len(p)).encode()).hexdigest()) for p, m in list(members.items())]


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("small", [10**6, 5])
def test_prefix_trie(spark, small):
    """Also with splicing of the tour down to five arcs."""
    rows = [(*r, "clash", 7, "x") for r in TURNS]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parent string, depth int, part string")
    got = prefix_trie.prefix_trie(table, small=small).select(*TRIE).collect()
    assert by_text(got) == by_text(brute_trie(TURNS))


def test_prefix_trie_of_no_conversations(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(table).collect() == []


def test_member_digests_are_packed(spark, monkeypatch):
    """A node at which many conversations end."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    ended = spark.range(1000).select((F.col("id") % 3).alias("conv"), F.lit(2).cast("long").alias("depth"), F.col("id").alias("member"))
    got = {r["conv"]: r["ends_sha256"] for r in prefix_trie.member_digests(ended, Scratch(spark, "digests")).collect()}
    assert got == {k: sha256(",".join(str(i) for i in range(1000) if i % 3 == k).encode()).hexdigest() for k in range(3)}


@pytest.mark.parametrize("small", [10**6, 3])
def test_list_ranks(spark, small):
    """Lists of several lengths, elements in no order."""
    arcs = [(lst, (k * 37) % 101, lst if k < n - 1 else None, ((k + 1) * 37) % 101 if k < n - 1 else None)
            for lst, n in ((1, 1), (2, 60), (3, 101)) for k in range(n)]
    table = spark.createDataFrame(arcs, "a long, b long, next_a long, next_b long").repartition(5)
    got = {(r["a"], r["b"]): r["rank"] for r in ordered.list_ranks(table, Scratch(spark, "ranks"), small).collect()}
    assert got == {(lst, (k * 37) % 101): n - k for lst, n in ((1, 1), (2, 60), (3, 101)) for k in range(n)}
