"""The trie of rebuilt conversations by plain dictionaries."""

import hashlib
import zlib
from collections import defaultdict


def rebuilt(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: [(role, text), ...]}"""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
    return sorted(
        (
            min(m), len(node), -1 if not node else min(members[node[:-1]]), len(m), len(children[node]), leaves[node],
            saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )
