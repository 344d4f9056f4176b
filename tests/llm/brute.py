"""Plain, single-process versions of the operators, written from their definitions."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def components(nodes, links):
    """Smallest reachable node of each node."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo.extend(near[x])
    return out


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return sorted((i, max(g), len(g), i == max(g), sha(t)) for t, g in groups.items() for i in g)


def fingerprint(text, shingle=3):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def simhash(rows, bits=2):
    fp = [(i, fingerprint(t)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(fp, 2) if bin(x ^ y).count("1") <= bits]
    comp = components([i for i, _ in fp], links)
    return sorted((i, f"{x:016x}", comp[i]) for i, x in fp)


def repeats(rows, n=200):
    """Bytes covered by n-byte strings that start in two places: (id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for s in range(len(b) - n + 1):
            seen[hashlib.md5(b[s : s + n]).digest()] += 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            if seen[hashlib.md5(b[s : s + n]).digest()] > 1:
                gone[s : s + n] = b"\x01" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(kept)))
    return sorted(out)


def lines(rows, max_ratio, min_pages):
    """(id, host, text) -> (id, text without boilerplate lines)."""
    pages, seen = Counter(), Counter()
    key = lambda x: x.strip(" \t\r\f\x0b")
    for _, host, text in rows:
        pages[host] += 1
        seen.update({(host, key(x)) for x in (text or "").split("\n") if key(x)})
    bad = {k for k, n in seen.items() if n >= min_pages and n > max_ratio * pages[k[0]]}
    out = []
    for i, host, text in rows:
        kept = None if text is None else "\n".join(x for x in text.split("\n") if (host, key(x)) not in bad)
        out.append((i, kept))
    return sorted(out, key=repr)


WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def fold(text) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def search(docs, items, k=50):
    """(item, rank, doc, score) of the best documents."""
    counts = [(i, Counter(WORD.findall(fold(t)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(WORD.findall(fold(t)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def h(*parts) -> str:
    return sha("".join(parts))


def merkle_paths(digests):
    """Root of a list of digests and for each the siblings, level by level: (side, digest)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, a in enumerate(at):
            other = a ^ 1
            paths[i].append((("R" if other > a else "L"), level[other]) if other < len(level) else ("N", ""))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [a // 2 for a in at]
    return (level[0] if level else ""), paths


def climb(leaf, path):
    for side, sibling in path:
        leaf = h(sibling, leaf) if side == "L" else h(leaf, sibling)
    return leaf


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: merkle_paths([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, upper = merkle_paths([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, upper):
        subroot, paths = trees[g]
        for (_, _, own, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), paths):
            whole, shown = path + above, own
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                shown = leaf((*r[:3], r[3] + 1, r[4]))
            folded = climb(shown, whole)
            out.append((r[0], own, subroot, root, h(*(d for _, d in whole)), folded, folded == root))
    return out


def tokens(text):
    return [w.decode("utf8", "surrogateescape") for w in re.split(rb"[\x20\x09-\x0D]+", fold(text).encode()) if w] + [None]


class Interpolation:
    """Mixture of the estimates of all orders; the n-gram () is the uniform estimate."""

    def __init__(self, training, left_out, order, tolerance, rounds):
        self.order = order
        self.learn(training)
        self.weights = defaultdict(lambda: None)
        events = [self.parts(g) for t in left_out for g in self.grams(t)]
        last = None
        for _ in range(rounds):
            mass, gain = defaultdict(lambda: [0.0] * (order + 1)), 0.0
            for bucket, shares in events:
                w = self.weight(bucket)
                total = sum(a * b for a, b in zip(w, shares))
                gain += math.log(total)
                for k in range(order + 1):
                    mass[bucket][k] += w[k] * shares[k] / total
            self.weights.clear()
            for bucket, m in mass.items():
                m = [x + 1 / 16 if k <= bucket[0] else 0.0 for k, x in enumerate(m)]
                self.weights[bucket] = [x / sum(m) for x in m]
            if not events or (last is not None and gain - last < tolerance * len(events)):
                break
            last = gain

    def learn(self, training):
        self.counts = Counter()
        for t in training:
            seq = ["<s>"] * (self.order - 1) + [(w,) for w in tokens(t)]
            for k in range(1, self.order + 1):
                self.counts.update(tuple(seq[i - k + 1 : i + 1]) for i in range(k - 1, len(seq)))
        own = [(g, n) for g, n in self.counts.items() if len(g) == 1 and g != ("<s>",)]
        self.n, self.v = sum(n for _, n in own), len(own)

    def grams(self, text):
        seq = ["<s>"] * (self.order - 1) + [(w,) for w in tokens(text)]
        return [tuple(seq[i - self.order + 1 : i + 1]) for i in range(self.order - 1, len(seq))]

    def parts(self, gram):
        shares, level, context = [1 / (self.v + 1), self.counts[gram[-1:]] / max(self.n, 1)], int(self.n > 0), 1
        for k in range(2, self.order + 1):
            above = self.counts[gram[-k:-1]]
            shares.append(self.counts[gram[-k:]] / max(above, 1))
            if above:
                level, context = k, above
        return (level, context.bit_length() - 1), shares

    def weight(self, bucket):
        own = sorted(b for b in self.weights if b[0] == bucket[0] and self.weights[b])
        below = [b for b in own if b <= bucket]
        if own:
            return self.weights[below[-1] if below else own[0]]
        return [1 / (bucket[0] + 1) if k <= bucket[0] else 0.0 for k in range(self.order + 1)]

    def chance(self, gram):
        bucket, shares = self.parts(gram)
        return sum(a * b for a, b in zip(self.weight(bucket), shares))
