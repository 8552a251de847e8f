"""Plain-Python versions of the newer operators, written from their contracts."""

import math
import re
import zlib
from collections import Counter

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_by_hand(docs):
    counts = Counter()
    for d in docs:
        key = "" if d["doc_id"] is None else str(d["doc_id"])
        for run in RUN.findall(d["text"] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % 31 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit_away(word, vocab, letters):
    """Every word of ``vocab`` one insertion, deletion or replacement from ``word``."""
    found = set()
    for i in range(len(word) + 1):
        if i < len(word):
            found.add(word[:i] + word[i + 1 :])
            for c in letters:
                found.add(word[:i] + c + word[i + 1 :])
        for c in letters:
            found.add(word[:i] + c + word[i:])
    found.discard(word)
    return {w for w in found if w in vocab}


def spelling_by_hand(docs):
    vocab = words_by_hand(docs)
    letters = sorted({c for w in vocab for c in w})
    near = {w: one_edit_away(w, vocab, letters) for w in vocab}
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda b: (-vocab[b], b), default=None)
        form[w] = best if best is not None and vocab[best] >= 10 * n else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root] is not None:
            root = form[root]
        f = form[w]
        out.append((w, f, root, n, len(near[w]), vocab[f] if f else None))
    return out


PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
WORD_IN_PIECE = re.compile(r"[^\x20\x09]+")


def collocations_by_hand(docs, top=2000):
    f, n = Counter(), Counter()
    for d in docs:
        lang = d.get("lang") or "und"
        for piece in PIECE.split((d["text"] or "").translate(LOWER)):
            ws = WORD_IN_PIECE.findall(piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f[(lang, " ".join(ws[i : i + k]))] += 1
    cands = {key: a for key, a in f.items() if a >= 10 and 2 <= len(key[1].split(" ")) <= 3}
    rows = []
    for (lang, phrase), a in cands.items():
        ws = phrase.split(" ")
        if len(ws) == 2 and any(
            len(p.split(" ")) == 3 and lg == lang and (p.startswith(phrase + " ") or p.endswith(" " + phrase))
            and 100 * b >= 50 * a
            for (lg, p), b in cands.items()
        ):
            continue
        cuts = []
        for k in range(1, len(ws)):
            l, r = f[(lang, " ".join(ws[:k]))], f[(lang, " ".join(ws[k:]))]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        rows.append((lang, phrase, a, l, r, n[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return out
