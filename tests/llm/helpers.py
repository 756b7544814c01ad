import random

WORD_LIST = [a + b for a in ("on", "re", "the", "an", "ti", "ou", "é") for b in ("", "ha", "ble", "er", "st", "ing", "ß")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r: random.Random, n: int) -> str:
    words, out = [r.choice(WORD_LIST) for _ in range(n)], []
    for k, w in enumerate(words):
        out.append(w.capitalize() if k % 9 == 0 else w)
        out.append(". " if k % 9 == 8 else "\n" if k % 31 == 30 else " ")
    return "".join(out).strip()


def edited(r: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = "edit" + str(r.randrange(10**6))
    return " ".join(words)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Prose with copies, near copies, shared passages, odd texts, nulls and repeated rows."""
    r = random.Random(seed)
    texts = [prose(r, r.randrange(60, 200)) for _ in range(n)]
    passage = prose(r, 70)
    texts += [texts[0], texts[0].upper().replace("É", "é"), texts[1] + " ", edited(r, texts[2], 3), edited(r, texts[2], 5), edited(r, texts[3], 1)]
    texts += [f"{prose(r, 40)}\n{passage}\n{prose(r, 40)}" for _ in range(4)]
    texts += ["", None, " ", "one", "one two", "One  Two", "a b c", "x" * 300, "ab " * 400, "▁ ▁▁ \t\x0b€ 漢字" * 3, "x" * 300, None, prose(r, 6000)]
    rows = [(i, t, ["en", None][i % 2], ["s1", "s2", "s3", None][i % 7 % 4], i) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return rows
