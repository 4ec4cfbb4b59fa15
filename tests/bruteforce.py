"""Pure-Python, loop-by-loop statement of the scoring model for tiny inputs:
every topic x every document x every query term, as the model defines it."""

import math
from collections import Counter


def grams(tokens):
    uni = [(1, t, "") for t in tokens]
    bi = [(2, a, b) for a, b in zip(tokens, tokens[1:])]
    return uni + bi


def score_all(docs, topics, feedback=False, k=100):
    """docs: {doc_id: [tokens]}, topics: {topic_id: [[tokens per field]]}."""
    post = {d: Counter(grams(t)) for d, t in docs.items()}
    dl = {d: sum(c for g, c in post[d].items() if g[0] == 1) for d in docs}
    n_docs = len(docs)
    avgdl = sum(dl.values()) // n_docs
    df = Counter(g for d in docs for g in post[d])
    qtf = {q: Counter(g for f in fields for g in grams(f)) for q, fields in topics.items()}
    qdf = Counter(g for q in topics for g in qtf[q])
    n_q = len(topics)

    def sim(q, d, boost=()):
        norm = 0.3 + 0.7 * dl[d] / avgdl
        s = {1: 0.0, 2: 0.0}
        for g, c in qtf[q].items():
            if post[d].get(g, 0) == 0:
                continue
            w = (c / norm) * math.log2(n_q / qdf[g]) * (post[d][g] / norm) * math.log2(n_docs / df[g])
            s[g[0]] += 2.0 * w if g in boost else w
        return 0.2 * s[1] + 0.8 * s[2]

    out = {}
    for q in topics:
        ranked = sorted(docs, key=lambda d: (-round(sim(q, d), 6), d))
        if feedback:
            fb = {g for d in ranked[:5] for g in post[d]}
            scores = {d: round(sim(q, d, fb), 6) for d in docs}
            ranked = sorted(docs, key=lambda d: (-scores[d], d))
        else:
            scores = {d: round(sim(q, d), 6) for d in docs}
        out[q] = [(d, scores[d]) for d in ranked[:k]]
    return out
