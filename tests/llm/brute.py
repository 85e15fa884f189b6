"""Plain, slow versions of the operators for small fixtures."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def repeated_words(rows, n):
    """(id, words, removed, digest of the rest)"""
    found = Counter(tuple(ws[i : i + n]) for _, t in rows for ws in [words(t)] for i in range(len(ws) - n + 1))
    out = []
    for doc, text in rows:
        ws = words(text)
        gone = set()
        for i in range(len(ws) - n + 1):
            if found[tuple(ws[i : i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((doc, len(ws), len(gone), sha(" ".join(w for i, w in enumerate(ws) if i not in gone))))
    return out


def repeated_bytes(rows, n):
    """(id, bytes, removed, spans, digest of the rest)"""
    texts = [(t or "").encode() for _, t in rows]
    found = Counter(b[i : i + n] for b in texts for i in range(len(b) - n + 1))
    out = []
    for (doc, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if found[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def shingles(text, n=3):
    ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else {tuple(ws)} if ws else set()


def jaccard(rows, part=90, n=3):
    """(id, set size, smallest id of the component)"""
    sets, parent, having = [shingles(t, n) for _, t in rows], list(range(len(rows))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in having[g] if j > i).items():
            if 100 * k >= part * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), doc) if x is not None), default=None)
    return [(doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)]


def base_counts(text):
    """(words, characters in words, symbols, repeated lines, words in repeated windows)"""
    text, ws = text or "", words(text)
    grams = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + k for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    symbols = sum(text.count(x) for x in "#*$%&|<>")
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered)


def distance_inside(pattern, text):
    """Edits between the pattern and the part of the text that fits best."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        now = [i + 1]
        for j, d in enumerate(text):
            now.append(min(row[j] + (c != d), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


def _in_order(rows):
    """conv_id: its (role, text) by turn, nulls first and empty"""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, x) for _, _, r, x in sorted(turns)] for conv, turns in by.items()}


def trie(rows):
    """(conv_id, depth, parent, members, children, leaves, saved, digest of ends) of rebuilt conversations, all prefixes listed"""
    own = _in_order(rows)
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        built[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    node, below, sums = defaultdict(list), defaultdict(list), {}
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            node[tuple(turns[:d])].append(conv)
    for seq in node:
        if seq:
            below[seq[:-1]].append(seq)
    for seq in sorted(node, key=len, reverse=True):
        leaves = sum(sums[s][0] for s in below[seq]) or 1
        sums[seq] = leaves, sum(sums[s][1] for s in below[seq]) + ((len(node[seq]) - 1) * len(seq[-1][1]) if seq else 0)
    out = []
    for seq, members in node.items():
        ends = sha(",".join(map(str, sorted(c for c in members if len(built[c]) == len(seq)))))
        parent = min(node[seq[:-1]]) if seq else None
        out.append((min(members), len(seq), parent, len(members), len(below[seq]), *sums[seq], ends))
    return out


BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        yield from [(conv, turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)


def edits(turns, faults):
    """(cost, letters, repaired turns): the cheapest way through all states by Dijkstra, equal costs by letters"""
    follows = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, letters, i, state, said = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, letters, said
        steps = [(5, "I", i, (role, "")) for role in ("user", "assistant")]
        if i < len(turns):
            role, text = turns[i]
            steps.append((2, "D", i + 1, None))
            if faults[i] in ("", "truncated"):
                more = 5 * (faults[i] == "truncated")
                steps += [(more, "K", i + 1, (role, text)), *((1 + more, "R", i + 1, (r, text)) for r in ("user", "assistant"))]
        for price, letter, j, turn in steps:
            if turn is None or (state, turn[0][:1]) in follows:
                now = (state, said) if turn is None else (turn[0][:1], (*said, turn))
                heapq.heappush(heap, (cost + price, letters + letter, j, *now))


def repair(rows, all_rows):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, letters, digest) for each conversation of all rows"""
    by = {conv: [] for conv, *_ in all_rows}
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role, text))
    out = []
    for conv, found in by.items():
        found.sort(key=lambda r: r[:2])
        turns, faults, seen = [r[2:] for r in found], [], set()
        for role, text in turns:
            bare = text.strip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            faults.append(fault)
            seen.add((role, text))
        numbers = [r[1] for r in found if r[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, letters, said = edits(turns, faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, letters, sha("\n".join(f"{r}:{x}" for r, x in said))))
    return out


def _holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(part) <= 255 for part in hit.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        total = sum(int(c) * (1 + i % 2) - 9 * (i % 2 and int(c) > 4) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return True


def private(text, patterns):
    """(start, kind, end) of the plain patterns' matches that hold"""
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, text or "") if _holds(kind, m.group())]
    return sorted(found)
