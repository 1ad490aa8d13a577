import hashlib
import heapq
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticemill.llm import chat, jpeg, top_k


def test_jpeg_round_trip():
    rnd = random.Random(1)
    for trial in range(40):
        n = rnd.choice([1, 2, 5, 70, 300])
        p = bytes(rnd.choice([128, 128, 128, 0, 255, 65]) if trial % 2 else rnd.randrange(256) for _ in range(64 * n))
        p = bytes([128]) * len(p) if trial == 3 else p
        image = jpeg.parse(jpeg.write(p))
        assert jpeg.payload_of(image, jpeg.decode([image])[0]) == p


def test_jpeg_many_at_once():
    payloads = [bytes(random.Random(i).randrange(256) for _ in range(64 * (i + 1))) for i in range(30)]
    images = [jpeg.parse(jpeg.write(p)) for p in payloads]
    assert [jpeg.payload_of(i, c) for i, c in zip(images, jpeg.decode(images), strict=True)] == payloads


def one_component_by_bits(values, restart):
    """A plain writer: bit by bit, DC predicted from the block before, a restart after every ``restart`` blocks (0: none)."""
    dc, ac = ({s: (c, n) for s, c, n in jpeg.codes(t)} for t in jpeg.own_tables())

    def put(bits, v, s):
        return bits + (format(v if v > 0 else v + (1 << s) - 1, f"0{s}b") if s else "")

    out, bits, before = b"", "", 0
    flush = lambda bits: (int(bits + "1" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big").replace(b"\xff", b"\xff\0") if bits else b"")
    for k, block in enumerate(values):
        if restart and k and k % restart == 0:
            out, bits, before = out + flush(bits) + bytes([0xFF, 0xD0 + (k // restart - 1) % 8]), "", 0
        d = int(block[0]) - before
        before = int(block[0])
        s = abs(d).bit_length()
        bits = put(bits + format(dc[s][0], f"0{dc[s][1]}b"), d, s)
        run = 0
        for v in map(int, block[1:]):
            if not v:
                run += 1
                continue
            while run > 15:
                bits, run = bits + format(ac[0xF0][0], f"0{ac[0xF0][1]}b"), run - 16
            s = abs(v).bit_length()
            code = ac[run << 4 | s]
            bits, run = put(bits + format(code[0], f"0{code[1]}b"), v, s), 0
        if run:
            bits += format(ac[0][0], f"0{ac[0][1]}b")
    return out + flush(bits)


@pytest.mark.parametrize("restart", [0, 1, 3])
def test_jpeg_decoder_reads_other_writers(restart):
    rng = np.random.default_rng(4)
    values = np.where(rng.random((12, 64)) < 0.2, rng.integers(-900, 900, (12, 64)), 0)
    values[3] = 0
    dc, ac = jpeg.own_tables()
    data = b"".join(
        [
            b"\xff\xd8", jpeg.segment(jpeg.DQT, bytes([0]) + bytes([2] * 64)), jpeg.segment(jpeg.SOF0, bytes([8, 0, 24, 0, 30, 1, 1, 0x11, 0])),
            jpeg.segment(jpeg.DHT, bytes([0]) + dc + bytes([0x10]) + ac), jpeg.segment(jpeg.DRI, restart.to_bytes(2, "big")) if restart else b"",
            jpeg.segment(jpeg.SOS, bytes([1, 1, 0, 0, 63, 0])), one_component_by_bits(values, restart), b"\xff\xd9",
        ]
    )
    image = jpeg.parse(data)
    found = jpeg.decode([image])[0]
    assert (found[:, 0, :] == values).all()
    grey = jpeg.thumbnail(image, found)
    assert grey.shape == (3, 4) and grey[0, 0] == np.clip((values[0, 0] * 2 + 4) // 8 + 128, 0, 255)


def test_jpeg_refuses_others():
    for bad in (b"", b"\x89PNG", b"\xff\xd8\xff\xc2\x00\x0b" + bytes(9), b"\xff\xd8"):
        with pytest.raises(ValueError):
            jpeg.parse(bad)


def test_store_texts(spark):
    texts = [None, "", "a" * 64, "é日本語" * 50, "x" * 70_000, "\0", "same", "same"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(None, "n", "")], "doc_id long, text string, feature string")
    rows = {r.doc_id: r for r in jpeg.store_texts(df, keep_media=True).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        p = raw + bytes(-len(raw) % 64 or 64 * (not raw))
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r.media_bytes == len(r.media) and hashlib.sha256(bytes(r.media)).hexdigest() == r.media_sha256
    assert rows[6].feature == rows[7].feature and rows[0].media_sha256 == rows[1].media_sha256 and None in rows
    assert jpeg.store_texts(df.where("false")).count() == 0


COSTS = chat.Costs()


def cheapest(codes):
    """Dijkstra over single steps: insert, append, merge."""
    best, heap = {(0, 0): 0}, [(0, 0, 0)]
    while heap:
        d, i, s = heapq.heappop(heap)
        if i == len(codes) and s == 3:
            return d
        steps = [(d + COSTS.insert, i, t) for t in chat.NEXT[s]]
        if i < len(codes):
            for role in range(1, 5):
                change = 0 if codes[i] == role else COSTS.name if codes[i] == 5 else COSTS.relabel
                if role in chat.NEXT[s]:
                    steps.append((d + change, i + 1, role))
                if role == s:
                    steps.append((d + change + COSTS.merge, i + 1, role))
        for n, j, t in steps:
            if n < best.get((j, t), 1 << 50):
                best[j, t] = n
                heapq.heappush(heap, (n, j, t))
    return None


def test_repair_is_cheapest():
    end = chat.ways(COSTS)[2]
    for n in range(1, 5):
        for codes in itertools.product(range(1, 6), repeat=n):
            assert chat.rest_costs(np.array(codes), end, COSTS)[0][0] == cheapest(codes)
            assert (chat.product(np.array(codes), COSTS)[0] + end).min() == cheapest(codes)


def test_chat_is_the_same_for_any_partitioning(spark):
    roles = ["user", "assistant", "USER ", "system", None, "tool", "bot", "weird"]
    rows = [(1, i, roles[i * 7 % 8], f"t{i} <|end|> x", "c") for i in range(400)] + [(2, i % 2, "user", "x", "c") for i in range(4)]
    rows += [(None, None, None, None, "c")] * 3 + [(3, None, "assistant", "only", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    a = chat.repair(df.repartition(1)).orderBy("conv_id", "seq").toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    b = chat.repair(df.repartition(5)).orderBy("conv_id", "seq").toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert a.astype(str).equals(b.astype(str)) and len(a) == len(rows)
    legal = {"": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user", "tool"}, "tool": {"assistant"}}
    for _, own in a.groupby("conv_id", dropna=False):
        assert list(own.seq) == list(range(len(own)))
        state = ""
        for r in own.itertuples():
            for role in [*r.inserted_before, *([] if r.action == "merge" else [r.new_role]), *r.inserted_after]:
                assert role in legal[state]
                state = role
            assert r.action != "merge" or state == r.new_role
        assert state == "assistant"
        whole = "".join(own.piece)
        assert whole.startswith("<|") and whole.endswith("<|end|>\n") and whole.count("<|end|>") == whole.count("|>\n") - whole.count("<|end|>\n")
    assert "".join(a[a.conv_id == 3].piece) == "<|user|>\n<|end|>\n<|assistant|>\nonly<|end|>\n"
    assert chat.repair(df.where("false")).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)], "c") for i in range(300)]
    rows += [(300 + i, [0.1] * 8, "c") for i in range(50)] + [(400, None, ""), (401, [float("nan")] * 8, ""), (402, [None] * 8, ""), (403, [], ""), (None, [0.1] * 8, "")]
    rows += [(420, [0.5, 0.5, -3.0], ""), (421, [1.0, 0.0, 0.0], ""), (7, rows[7][1], "twice")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = top_k.search(df, F.col("vec_id") % 20 == 0).toPandas()
    usable = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v, _ in rows if i is not None and v and None not in v and not np.isnan(v).any()]
    for i, q in [(i, q) for i, q in usable if i % 20 == 0]:
        want = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))[:20]
        own = got[got.query_id == i].sort_values("rank")
        assert [(-s, j) for s, j in zip(own.score, own.vec_id, strict=True)] == want and list(own["rank"]) == list(range(1, len(want) + 1))
    assert set(got.query_id) == {i for i, _ in usable if i % 20 == 0}
    assert top_k.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_bit_sliced_block():
    rng = np.random.default_rng(7)
    for n in (1, 63, 64, 65, 500):
        values = rng.integers(-40, 41, (n, 5))
        block = top_k.Block(np.arange(n) * 3, *top_k.slices_of(values))
        for q in (rng.integers(-30, 31, 5), np.zeros(5, dtype=np.int64)):
            ids, scores = block.search(q, 10)
            want = sorted((-int(s), i * 3) for i, s in enumerate(values @ q))[:10]
            assert sorted((-int(s), int(i)) for i, s in zip(ids, scores, strict=True)) == want


def test_ids_beside_nulls(spark):
    """Longs beyond 2^53 stay exact where a null stands beside them."""
    import public_tokenizers

    from noticemill.llm import packing, quality, tokens

    big = 2**60 + 1
    df = spark.createDataFrame([(None, "some text"), (big, "other text"), (big + 2, None)], "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    path = public_tokenizers.path("word_bpe_49k.json")
    for out in (jpeg.store_texts(df), tokens.count_tokens(df, path), packing.pack(df, path), quality.score_quality(df, labels, F.lit(False))):
        assert {r.doc_id for r in out.select("doc_id").collect()} == {None, big, big + 2}


def test_top_k_of_large_components(spark):
    rows = [(i, [float((-1) ** i * (i * 7919 % 1000) * 1e4 + i), 3e5 * i, -1.0]) for i in range(60)]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 5).collect()}
    q = {i: [int(x * 64 // 1) for x in v] for i, v in rows}
    for a in (0, 20, 40):
        best = sorted(((-sum(x * y for x, y in zip(q[a], q[b], strict=True)), b) for b in q if b != a))[:5]
        assert [got[a, k + 1] for k in range(5)] == [(b, -s) for s, b in best]


def test_jpeg_of_several_scans_is_refused():
    """A scan that names fewer components than the frame."""
    one = jpeg.write(bytes(range(64)) * 3)
    at = one.index(bytes([0xFF, jpeg.SOF0]))
    size = int.from_bytes(one[at + 2 : at + 4], "big")
    frame = one[at + 4 : at + 2 + size]
    three = bytes([3]) + bytes([frame[6], 0x11, frame[8]]) + bytes([frame[6] + 1, 0x11, frame[8]]) + bytes([frame[6] + 2, 0x11, frame[8]])
    body = frame[:5] + three
    other = one[: at + 2] + (2 + len(body)).to_bytes(2, "big") + body + one[at + 2 + size :]
    with pytest.raises(ValueError, match="several scans"):
        jpeg.parse(other)


def test_a_long_text_is_stored_whole(spark):
    text = " ".join(f"w{i}" for i in range(400_000))
    raw = text.encode() + bytes(-len(text) % 64)
    row = jpeg.store_texts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_bytes, row.payload_bytes, row.payload_sha256) == (len(text), len(raw), hashlib.sha256(raw).hexdigest())


def test_top_k_over_many_blocks(spark, monkeypatch):
    """Several index blocks, query blocks and groups of them give what one of each gives."""
    rnd = random.Random(12)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4 if i % 5 else 3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, top_k.search(df, F.col("vec_id") % 3 == 0, 7).collect()))
    for block, asked, together in ((37, 11, 1), (90, 5, 3)):
        monkeypatch.setattr(top_k, "BLOCK_ROWS", block)
        monkeypatch.setattr(top_k, "QUERY_ROWS", asked)
        monkeypatch.setattr(top_k, "PARTS_TOGETHER", together)
        assert sorted(map(tuple, top_k.search(df, F.col("vec_id") % 3 == 0, 7).collect())) == want
