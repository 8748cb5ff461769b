"""Counts per document for the quality rules, taken for a whole batch of texts at once."""

from __future__ import annotations

import numpy as np

from millwatch.llm import octets

SYMBOLS = b"#*$%&|<>"
WINDOW = 3
NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits")


def counts_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Whole-number counts of each text, by the names in NAMES.

    Words are runs without ASCII white space; word_chars are code points in them; lines are split at line feeds and
    count if they hold a word; a repeated word lies in a three-word window that the text has twice or more.
    """
    o = octets.Octets(texts)
    data = o.data
    flag = np.zeros(256, bool)
    flag[list(SYMBOLS)] = True

    def inside(mask: np.ndarray) -> np.ndarray:
        return octets.counts(o.owner(np.flatnonzero(mask)), o.n)

    in_word = octets.word_mask()[data]
    starts, ends = o.runs(in_word)
    owner = o.owner(starts)
    head = in_word & ((data & 0xC0) != 0x80)
    total = np.r_[0, np.cumsum(head)]
    out = {"n_words": octets.counts(owner, o.n), "word_chars": total[o.ends] - total[o.starts]}
    out["n_symbols"] = inside(flag[data])
    out["n_upper"] = inside((data >= 0x41) & (data <= 0x5A))
    out["n_digits"] = inside((data >= 0x30) & (data <= 0x39))

    # every text ends in a separator, so each line does
    stop = np.flatnonzero(data == 0x0A)
    begin = np.r_[0, stop[:-1] + 1] if len(stop) else stop
    words = np.r_[0, np.cumsum(in_word)]
    full = words[stop] > words[begin]
    begin, stop = begin[full], stop[full]
    of = o.owner(begin)
    out["n_lines"] = octets.counts(of, o.n)
    lines = octets.content_hash(data, begin, stop)
    _, kept = octets.distinct(lines, of)
    out["n_dup_lines"] = out["n_lines"] - octets.counts(kept, o.n)

    out["n_repeat_words"] = np.zeros(o.n, np.int64)
    if len(starts) >= WINDOW:
        prints = octets.content_hash(data, starts, ends)
        key = prints[: 1 - WINDOW]
        for k in range(1, WINDOW):
            key = octets.mix(key * np.uint64(3) + prints[k : len(prints) - WINDOW + 1 + k])
        whole = np.flatnonzero(owner[: 1 - WINDOW] == owner[WINDOW - 1 :])
        key = key[whole]
        order = np.lexsort((key, owner[whole]))
        k, d = key[order], owner[whole][order]
        same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
        often = np.zeros(len(order), bool)
        often[1:] |= same
        often[:-1] |= same
        repeated = np.zeros(len(starts), bool)
        at = whole[order[often]]
        for w in range(WINDOW):
            repeated[at + w] = True
        out["n_repeat_words"] = octets.counts(owner[repeated], o.n)
    return out
