"""Plain versions of the corpus operators, one document at a time, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

from gridlloyd.llm import quality
from gridlloyd.llm.byte_bpe import read_ranks

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(data: bytes) -> bytes:
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), data)


def token_counts(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, text in docs:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((i, len((text or "").encode()), n, n > 1024))
    return out


def _smallest(ids):
    named = [i for i in ids if i is not None]
    return min(named) if named else None


def simhash(docs):
    prints = []
    for _, text in docs:
        words = WORD.findall(lower((text or "").encode()))
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(docs)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    values = np.array(prints, "uint64")
    for a in range(len(docs)):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= 4):
            group[root(a)] = root(int(b))
    members = defaultdict(list)
    for i in range(len(docs)):
        members[root(i)].append(docs[i][0])
    return [(docs[i][0], f"{prints[i]:016x}", _smallest(members[root(i)])) for i in range(len(docs))]


def token_files(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def quality_base(docs):
    out = []
    for i, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
        again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        seen, repeats = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                repeats += line in seen
                seen.add(line)
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        out.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(again), failed))
    return out


def warc(pages):
    groups = defaultdict(list)
    for i, _, html in pages:
        payload = (html or "").encode()
        if len(payload) >= 1000:
            groups[payload].append(i)
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        ids = groups.get(payload, [])
        last = max((x for x in ids if x is not None), default=None)
        revisit = last is not None and i != last
        out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
                    last if revisit else None))
    return out


def bench_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((text or "").encode()))


def hit_words(docs, items):
    """Per document: its words, the hit places, the items."""
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        size = min(10, len(words))
        if size and item is not None:
            for k in range(len(words) - size + 1):
                windows[tuple(words[k:k + size])].add(str(item))
    out = []
    for _, text in docs:
        words, hit, found = bench_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                which = windows.get(tuple(words[k:k + size]))
                if which:
                    hit.update(range(k, k + size))
                    found |= which
        out.append((words, hit, found))
    return out


def decontaminate(docs, items):
    return [(i, len(words), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit))
            for (i, _), (words, hit, found) in zip(docs, hit_words(docs, items))]


def repeats(docs, depth=200):
    texts = [(text or "").encode() for _, text in docs]
    count = Counter(t[k:k + depth] for t in texts for k in range(len(t) - depth + 1))
    out = []
    for (i, _), t in zip(docs, texts):
        gone = np.zeros(len(t) + 1, "int64")
        for k in range(len(t) - depth + 1):
            if count[t[k:k + depth]] > 1:
                gone[k] += 1
                gone[k + depth] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha(bytes(x for x, g in zip(t, gone) if not g))))
    return out


def codec(docs):
    ranks = read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={t: r for r, t in enumerate(ranks)})
    out = []
    for i, text in docs:
        ids = encoding.encode_ordinary(text or "")
        out.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    return out


def clean_lines_of_others(docs):
    """Per document: lines, dropped lines, text left."""
    def key(line):
        key = lower(re.sub(rb"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", b"", line.encode()))
        return key if len(key.decode()) >= 10 else None

    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) is None or len(holders[key(x)]) < 2 or _smallest(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_dedup(docs):
    return [(i, n, dropped, sha(text.encode())) for i, n, dropped, text in clean_lines_of_others(docs)]


def _line_gone(line):
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    low = lower(line.encode()).decode()
    if any(p in low for p in (*quality.BOILERPLATE, "{", "}")):
        return True
    if len(re.findall(r"[ \t\x0b\x0c\r][|»>•·/][ \t\x0b\x0c\r]", low)) > 1:
        return True
    padded = f" {low} "
    furniture = any(re.search(f"[^a-z0-9]{re.escape(p)}[^a-z0-9]", padded) for p in quality.NAVIGATION)
    return len(words) < quality.SHORT_LINE and (words[-1][-1] not in quality.SENTENCE_ENDS or furniture)


def quality_stage(docs):
    out = []
    for row, base in zip(docs, quality_base(docs)):
        lines = (row[1] or "").split("\n")
        gone = [bool(re.search(r"[^\x20\x09-\x0D]", x)) and _line_gone(x) for x in lines]
        lost = sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x, g in zip(lines, gone) if g)
        if not base[-1] and 100 * lost <= 30 * base[2]:
            out.append((row[0], "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def near_dedup_stage(docs):
    first = {}
    for (i, text), (_, _, component) in sorted(zip(docs, simhash(docs)), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        first.setdefault(component, (i, text))
    return list(first.values())


def decontaminate_stage(docs, items):
    out = []
    for (i, text), (words, hit, _) in zip(docs, hit_words(docs, items)):
        if 100 * len(hit) > 50 * len(words):
            continue
        raw, kept, at = text.encode(), [], 0
        places = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(raw))]
        for k in sorted(hit):
            if k - 1 not in hit:
                kept.append(raw[at:places[k][0]])
            at = places[k][1]
        out.append((i, b"\n".join([*kept, raw[at:]]).decode()))
    return out


def pipeline(docs, items):
    docs = quality_stage(docs)
    docs = [(i, text) for i, _, _, text in clean_lines_of_others(docs)]
    return codec(decontaminate_stage(near_dedup_stage(docs), items))
