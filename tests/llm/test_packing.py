import random
from collections import defaultdict

import numpy as np

from ruleweave.llm import packing as P


def test_best_fit_decreasing_matches_a_plain_search():
    rnd = random.Random(31)
    for limit in (1, 7, 16, 100):
        lengths = np.array([rnd.randint(1, limit) for _ in range(300)])
        rooms, rows = [], []
        for piece in sorted(range(300), key=lambda i: -lengths[i]):
            n = lengths[piece]
            fits = [r for r in rooms if r >= n]
            if fits:
                at = max(i for i, r in enumerate(rooms) if r == min(fits))
                rooms[at] -= n
            else:
                rooms.append(limit - n)
        rows = P.best_fit_decreasing(lengths, limit)
        assert sorted(p for r in rows for p in r) == list(range(300))
        assert all(sum(lengths[p] for p in r) <= limit for r in rows)
        assert sorted(limit - sum(lengths[p] for p in r) for r in rows) == sorted(rooms)


def check(df, texts, limit):
    encoding = P.encoding(P.read_vocabulary(P.VOCABULARY))
    end = encoding.max_token_value + 1
    got, rows = defaultdict(list), df.collect()
    for r in rows:
        ids, positions = (np.frombuffer(bytes(x), "<u2") for x in (r.input_ids, r.position_ids))
        assert len(ids) == len(positions) == limit and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens:] == end).all() and not positions[r.n_tokens:].any()
        for d, start, a, b in zip(r.doc_ids, r.token_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (positions[a:b] == np.arange(b - a)).all()
            got[d].append((start, ids[a:b]))
    assert len({(r.shard, r.row) for r in rows}) == len(rows)
    for d, copies in texts.items():
        tokens = defaultdict(list)
        for start, ids in got.pop(d, []):
            tokens[start].append(ids)
        kept = [t for t in copies if t]
        assert sum(len(x) for x in tokens.values()) == sum(-(-(len(encoding.encode_ordinary(t)) + 1) // limit) for t in kept)
        if len(set(kept)) == 1:
            whole = np.concatenate([tokens[k][0] for k in sorted(tokens)])
            assert whole[-1] == end and encoding.decode(whole[:-1].tolist()) == kept[0]
    assert not got
    return rows


ROWS = [(0, None), (1, ""), (2, " "), (3, "<|endoftext|> is text"), (4, "É日 " * 5000), (5, "same"), (5, "same"), (None, "no id")] + [
    (i, " ".join(f"w{i * j % 97}" for j in range(i * 7 % 400))) for i in range(10, 80)]


def test_round_trip(frame):
    texts = defaultdict(list)
    for i, t in ROWS:
        texts[i].append(t)
    for chunk in (P.CHUNK_TOKENS, 300):
        check(P.pack(frame(ROWS).coalesce(2), row_tokens=64, chunk_tokens=chunk), texts, 64)
    rows = check(P.pack(frame(ROWS).coalesce(1), row_tokens=2048), texts, 2048)
    assert sum(r.n_tokens for r in rows) > 0.9 * 2048 * len(rows)


def test_empty_table(frame):
    assert P.pack(frame([])).collect() == []
