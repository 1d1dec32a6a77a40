"""The text rules stated once more in plain Python, to check the column expressions against."""

from penmark.functions import lexicon as lx


def clean(text, keep=""):
    out = []
    for c in text or "":
        if c in lx.DIACRITICS or c == lx.TATWEEL:
            continue
        c = lx.FOLD_TO[lx.FOLD_FROM.index(c)] if c in lx.FOLD_FROM else c
        out.append(c if "؀" <= c <= "ۿ" or c in keep else " ")
    return " ".join("".join(out).split())


def tokens(cleaned, stop=lx.STOP_WORDS):
    return [w for w in cleaned.split() if len(w) >= 2 and w not in stop]


def style(raw, cleaned, toks):
    words = cleaned.split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:]) if a in lx.ENTITY_MARKERS]
    return (
        sum(map(len, toks)) / len(toks) if toks else 0.0,
        sum((raw or "").count(q) for q in lx.QUESTION_MARKS),
        sum(t in lx.PREPOSITIONS for t in toks),
        sum(t in lx.FIRST_PERSON for t in toks),
        len(set(pairs)) / len(pairs) if pairs else 0.0,
    )
