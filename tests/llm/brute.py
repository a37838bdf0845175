"""Plain versions of the operators, for small inputs, from their contracts alone."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def shingles(text):
    w = BLANKS.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near(rows):
    """doc_id -> (set size, component, kept)"""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(a), root(i), root(i) == i) for i, a in sets}


def repeats(rows, size=50):
    """doc_id -> (bytes, removed, spans, digest of the rest)"""
    data = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in data:
        for k in range(len(b) - size + 1):
            w = b[k : k + size]
            least[w] = min(i, least.get(w, i))
    out = {}
    for i, b in data:
        gone = [False] * len(b)
        for k in range(len(b) - size + 1):
            if least[b[k : k + size]] < i:
                gone[k : k + size] = [True] * size
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g)))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def joined(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], kinds.index(s[2]))))


def personal(text):
    text, found = text or "", []
    found += [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return found


def secret(text):
    text, found = text or "", []
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    key = "[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"""({names}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), m.end(), "assign"))
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return found


def contamination(rows, items):
    """doc_id -> (words, hit, items, digest, contaminated)"""
    seqs = [(str(i), LETTERS.findall((t or "").translate(LOWER))) for i, t in items]
    windows = defaultdict(set)
    for i, w in seqs:
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in rows:
        w = LETTERS.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def lines(rows, min_lines=2, min_words=5):
    """doc_id -> (lines, deleted, runs, remaining text)"""
    solid = {}
    for i, t in rows:
        every = (t or "").split("\n")
        solid[i] = [(n, x, len(BLANKS.findall(x))) for n, x in enumerate(every) if BLANKS.search(x)]
    first = {}
    for i in sorted(solid):
        own = solid[i]
        for k in range(len(own)):
            if own[k][2] >= min_words:
                first.setdefault((own[k][1],), (i, k))
            if k + min_lines <= len(own):
                first.setdefault(tuple(x for _, x, _ in own[k : k + min_lines]), (i, k))
    out = {}
    for i, t in rows:
        own, gone = solid[i], set()
        for k in range(len(own)):
            if own[k][2] >= min_words and first[(own[k][1],)] != (i, k):
                gone.add(k)
            if k + min_lines <= len(own) and first[tuple(x for _, x, _ in own[k : k + min_lines])] != (i, k):
                gone |= set(range(k, k + min_lines))
        numbers = {own[k][0] for k in gone}
        rest = "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in numbers)
        out[i] = (len(own), len(gone), sum(k - 1 not in gone for k in gone), rest)
    return out


def words(text):
    return len(BLANKS.findall(text or ""))


def mix(rows, seed="mix"):
    """(doc_id, source, text) rows -> doc_id -> (size, source size, target, taken)"""
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += words(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, sum(sizes.values()), set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(3 * sizes[s] for s in over)
        free -= set(over)
    out = {}
    for s in order:
        own = sorted(((hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), str(i), words(t), i) for i, x, t in rows if x == s))
        whole, rest = divmod(round(target[s]), sizes[s]) if sizes[s] else (0, 0)
        so_far = 0
        for _, _, n, i in own:
            out[i] = (n, sizes[s], target[s], n * min(3, whole + (rest > 0 and 2 * so_far + n <= 2 * rest)))
            so_far += n
    return out


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def middle(doc_id, text):
    """(code points, form, prefix, middle, digest of the output, digest of the text)"""
    text, digest = text or "", sha(f"1:{'null' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    p, m, s = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, a, b - a, sha(out), sha(text)


def rebuilt(rows, family=5, most=9):
    """conv_id -> list of (role, text), after the first turns were replaced by those of the family's first one"""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    order = lambda t: (t[0], t[1], sha(f"{len(t[2])}:{t[2]}{t[3]}"))
    own = {c: [t[2:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(math.fmod(c, family))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(conversations):
    """Rows of every node, from all members of all prefixes"""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, out = Counter(p[:-1] for p in members if p), []
    below = {p: [0, 0] for p in members}
    for p, who in members.items():
        for d in range(len(p) + 1):
            below[p[:d]][0] += not children[p]
            below[p[:d]][1] += (len(who) - 1) * (len(p[-1][1].encode()) if p else 0)
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(conversations[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], *below[p], sha(ends)))
    return out


def toxic_score(folded, model):
    """Score of a folded text: term hits between letters, less those within an exception phrase, by a plain search"""
    def hits(term):
        return [m.span() for m in re.finditer(rf"(?<![^\W\d_]){re.escape(term)}(?![^\W\d_])", folded)]

    spared = [s for phrase in model.exceptions for s in hits(phrase)]
    total = sum(w for term, w in model.weights.items() for a, b in hits(term) if not any(x <= a and b <= y for x, y in spared))
    x = math.log1p(100 * total / (len(folded.split()) + 20))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * (x - model.middle)))))
