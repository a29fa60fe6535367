"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, width=10):
    windows = {}
    for name, text in items:
        words = tuple(BENCH_WORD.findall(lower(text or "")))
        for s in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(words[s:s + width], set()).update([] if name is None else [str(name)])
    out = []
    for doc_id, text in docs:
        words = tuple(BENCH_WORD.findall(lower(text or "")))
        hit, found = set(), set()
        for length in {len(w) for w in windows}:
            for s in range(len(words) - length + 1):
                if words[s:s + length] in windows:
                    hit.update(range(s, s + length))
                    found |= windows[words[s:s + length]]
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return out


def substrings(docs, width):
    words = [BLANK_WORD.findall(text or "") for _, text in docs]
    counts = Counter(tuple(w[s:s + width]) for w in words for s in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for s in range(len(w) - width + 1):
            if counts[tuple(w[s:s + width])] > 1:
                gone.update(range(s, s + width))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def pieces(text, reference):
    """Greedy longest matches, by search."""
    n = at = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in reference:
            end += 1
        n, at = n + 1, max(end - 1, at + 1)
    return n


def simhash(text, width=3):
    words = BLANK_WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints, distance=3):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                parent[root(i)] = root(j)
    members = {}
    for i, name in enumerate(ids):
        members.setdefault(root(i), []).append(name)
    least = {r: min((m for m in own if m is not None), default=None) for r, own in members.items()}
    return [least[root(i)] for i in range(len(ids))]


def lines(docs, min_chars=10):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in docs:
        own = (text or "").split("\n")
        kept = []
        for line in own:
            held = holders.get(key(line), {doc_id})
            first = min((h for h in held if h is not None), default=None)
            if len(held) < 2 or doc_id == first:
                kept.append(line)
        out.append((doc_id, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Shares by weight; what is above a limit is dealt to the others until nothing is."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        if not free:
            return fixed
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if level * weight[n] > repeats * sizes[n]]
        if not over:
            return fixed | {n: level * weight[n] for n in free}
        for n in over:
            fixed[n] = float(repeats * sizes[n])
            left -= fixed[n]


def quality(text):
    text = text or ""
    words = BLANK_WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    real = [line for line in text.split("\n") if BLANK_WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(real) - len(set(real)), len(covered),
    )


def rebuilt(turns):
    """Conversations put together anew from (id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, mark), role, text))
    own = {c: [(r, t) for _, r, t in sorted(rows)] for c, rows in own.items()}
    out = {}
    for conv, rows in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(math.fmod(conv, 100))
        out[conv] = own.get(base, [])[:h] + rows[h:]
    return out


def trie(convs):
    """Rows of the trie of {id: [(role, text), ...]}."""
    members, ends = {}, {}
    for conv, rows in convs.items():
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(conv)
        ends.setdefault(tuple(rows), []).append(conv)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[c] for c in below) if below else 1
        own = (len(members[key]) - 1) * len(key[-1][1]) if key else 0
        saved[key] = own + sum(saved[c] for c in below)
    return [
        (
            min(own), len(key), min(members[key[:-1]]) if key else None, len(own), len(children.get(key, [])), leaves[key],
            saved[key], sha(",".join(map(str, sorted(ends.get(key, [])))))
        )
        for key, own in members.items()
    ]


def mix(docs, weights=(5, 2, 1), share=1.5, repeats=2, cut=True):
    """(id, size, taken) of (id, text, source): one order by virtual finish times, cut at the budget."""
    rows = [(i, len(BLANK_WORD.findall(t or "")), s, hashlib.md5(f"mix:{hashlib.md5((t or '').encode()).hexdigest() if i is None else i}".encode()).hexdigest())
            for i, t, s in docs]
    sizes = {}
    for _, n, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes, weights, share, repeats)
    order = []
    for s in sizes:
        sent = 0
        queue = sorted((tag, n, k) for k, (_, n, own, tag) in enumerate(rows) if own == s)
        for copy in range(repeats):
            for tag, n, k in queue:
                sent += n
                if n:
                    order.append((sent / goal[s], s is None, s or "", tag, n, copy, k))
    left = int(round(sum(goal.values()), 6)) if cut else sum(2 * n for n in sizes.values())
    taken = [0] * len(rows)
    for *_, n, _, k in sorted(order):
        taken[k] += min(n, left)
        left -= min(n, left)
    return [(i, n, taken[k]) for k, (i, n, _, _) in enumerate(rows)]
