"""Plain re-computations of the training-data operators, for small inputs."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece

WORD = re.compile("[^\x20\x09-\x0d]+")
BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def piece_counts(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return [len(model.encode(t or "")) for t in texts]


def token_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def _any_case(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(?:" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|"
          + _any_case("api") + "_?" + _any_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    """[(start, kind number, kind, end)] of the base rules."""
    out = []
    for k, (kind, pattern, group, least) in enumerate(
            [("assign", ASSIGN, 1, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return sorted(out)


def shingles(text):
    w = lower(text or "").split(" ") if False else [lower(x) for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(rows):
    """{doc_id: (set size, component)} for [(doc_id, text)]; all pairs are compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def quality_base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    fives = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = Counter(fives)
    repeated = {i + k for i, f in enumerate(fives) if count[f] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(w) < 10 or 100 * len(repeated) > 20 * len(w))


def bench_windows(text):
    w = BENCH_WORD.findall(lower(text or ""))
    return {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()


def contamination(texts, items):
    """[(n_words, n_hit, item ids)] for item rows (id, text)."""
    owners = defaultdict(set)
    for item, text in items:
        for f in bench_windows(text):
            owners[f].add(item)
    lengths = {len(f) for f in owners}
    out = []
    for text in texts:
        w = BENCH_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                f = tuple(w[i:i + n])
                if f in owners:
                    hit |= set(range(i, i + n))
                    found |= owners[f]
        out.append((len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Excess over the limit is shared again by weight until none is above."""
    total = share * sum(sizes)
    w = [weights[i % 3] for i in range(len(sizes))]
    capped = set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        rest = [i for i in range(len(sizes)) if i not in capped]
        goal = [most * sizes[i] if i in capped else left * w[i] / sum(w[j] for j in rest) for i in range(len(sizes))]
        new = {i for i in rest if goal[i] > most * sizes[i]}
        if not new:
            return goal
        capped |= new


# --- 11, 12, 13 ------------------------------------------------------------------------

def top_k(rows, asks, best=5):
    """(query_id, rank, vec_id, score) for (vec_id, embedding) rows."""
    whole = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows
             if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for k, (q, e) in enumerate(whole):
        if asks(q):
            scores = [(-min(max(sum(a * b for a, b in zip(e, c)), -2**63), 2**63 - 1), i, j)
                      for j, (i, c) in enumerate(whole) if j != k and len(c) == len(e)]
            out += [(q, r + 1, i, -s) for r, (s, i, _) in enumerate(sorted(scores)[:best])]
    return out


def lexical_terms(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranked(docs, items, best=10):
    """(item_id, rank, doc_id, score) for (doc_id, text) and (item_id, text) rows."""
    counted = [(d, Counter(lexical_terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            n = sum(c.values())
            m = 100 - 75 + 75 * n * n_docs // length if n else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in lexical_terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:best])]
    return out


def alignments(rows):
    """Digest columns of (doc_id, text) rows, token by token."""
    from tokenizers import Tokenizer

    a_lib, b_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_lib.encode_special_tokens = True
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in signs} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in signs)}
    found = []
    for doc, text in rows:
        want = (" " + (text or "")).encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(byte[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            found.append((doc, [], [], "", []))
            continue
        a_ends, b_ends = list(itertools.accumulate(map(len, a_bytes))), list(itertools.accumulate(map(len, b_bytes)))
        groups, lo = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append(",".join(str(i) for i, e in zip(a, a_ends) if lo < e <= cut) + "|"
                          + ",".join(str(i) for i, e in zip(b, b_ends) if lo < e <= cut))
            lo = cut
        owner = [[j for j, t in enumerate(side) for _ in t] for side in (a_bytes, b_bytes)]   # token of every byte
        links = [(a[x], b[y]) for x, y in sorted(set(zip(*owner)))]
        found.append((doc, a, b, ";".join(groups), links))
    counts = Counter(pair for *_, links in found for pair in set(links))
    top = Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    return [(doc, len(a), len(b), len(g.split(";")) if g else 0, len(links),
             sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for doc, a, b, g, links in found]
