"""Plain single-thread versions of the operators, for comparison on small inputs."""

import re


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def jaccard_components(rows, size, num, den):
    """``rows``: (id, text). Returns (id, set size, component) per row."""
    sets = [shingle_set(t, size) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                top[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            r = find(i)
            least[r] = min(least.get(r, k), k)
    return [(k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def _contract_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def decontaminate(docs, items, size=13):
    """``docs``, ``items``: (id, text). Returns (id, words, hit words, items, their digest, contaminated) per document."""
    import hashlib

    windows = {}
    for k, text in items:
        w = _contract_words(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if k is None else str(k))
    sizes = {len(w) for w in windows}
    out = []
    for k, text in docs:
        w = _contract_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((k, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def base_secrets(text):
    """(kind, start, end) of the base patterns, by start, then kind."""
    out = []
    for order, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            size = len(m[2]) - 12 if kind == "assign" else len(m[0]) - (18 if kind == "access" else 16)
            if size >= 0:
                out.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def entropy_spans(text, classes, allowed, window):
    import math
    from collections import Counter

    out = []
    for m in re.finditer(r"[A-Za-z0-9+/=_-]{%d,}" % window, text or ""):
        word = m[0]
        kind = next((c for c in classes if re.search(c.covers.replace(r"\z", r"\Z"), word)), None)
        if kind is None or any(re.search(a.replace(r"\z", r"\Z"), word) for a in allowed):
            continue
        word = word.lower() if kind.fold else word
        best = max(
            -sum(c / window * math.log2(c / window) for c in Counter(word[i : i + window]).values())
            for i in range(len(word) - window + 1)
        )
        if best >= kind.least_bits - 1e-9:
            out.append((m.start(), m.end()))
    return out


def warc(pages, least=1000):
    """``pages``: (id, html). Returns (id, bytes, digest, kind, refers to)."""
    import hashlib

    data = [(k, (h or "").encode()) for k, h in pages]
    latest = {}
    for k, p in data:
        if len(p) >= least and k is not None:
            latest[p] = max(latest.get(p, k), k)
    out = []
    for k, p in data:
        top = latest.get(p)
        again = top is not None and k != top
        out.append((k, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", top if again else None))
    return out


def top_k(vectors, k=10, every=100):
    """``vectors``: (id, components). Returns (query, rank, id, score)."""
    import math

    rows = sorted(
        {
            (i, tuple(math.floor(1024 * float(x)) for x in v))
            for i, v in vectors
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
        }
    )
    out = []
    for i, q in rows:
        if i % every:
            continue
        found = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return out


def collocations(rows, most=3, least=10, covered=50, top=2000):
    """``rows``: (lang, text). Returns (lang, rank, phrase, a, l, r, n, score)."""
    from collections import Counter, defaultdict

    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, most + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = []
        longer = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in longer.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= covered * counts[p[i : i + size]]:
                        gone.add(p[i : i + size])
        for p, a in longer.items():
            if p not in gone:
                cuts = [(counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, x, y = min((1000000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
                found.append((-score, -a, " ".join(p).encode(), x, y))
        for rank, (score, a, phrase, x, y) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, n[lang], -score))
    return out


def conversation_trie(rows):
    """``rows``: (conv_id, turn, role, text). Returns the columns of the nodes."""
    import hashlib
    import zlib
    from collections import defaultdict

    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append((t is not None, t or 0, digest, role, text))
    own = {c: [(role, text) for *_, role, text in sorted(v)] for c, v in turns.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, path in full.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[b] for b in below) if below else 1
        own_saved = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own_saved + sum(saved[b] for b in below)
    out = []
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(full[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((
            min(ids), len(path), parent, len(ids), len(children[path]), leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out
