import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "an er the in or ti sh ou re ha ed is at bl wh ly es nt ou th".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4))) for _ in range(n))


def corpus(seed=5, n=60):
    """Documents with exact and near copies, repeated lines, null and empty texts, a long text and repeated rows."""
    rng = random.Random(seed)
    shared = [prose(rng, 12) for _ in range(4)]
    out = []
    for k in range(n):
        lines = [prose(rng, rng.randint(4, 25)) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(shared))
        out.append((k, "\n".join(lines)))
    for k in range(n, n + 15):
        words = out[rng.randrange(n)][1].split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        out.append((k, " ".join(words)))
    big = out[3][1]
    for k in range(n + 15, n + 35):
        out.append((k, big if k % 2 else big.replace("the", "thé", 1)))
    out += [(200, None), (201, ""), (202, " \n\t"), (203, "one two"), (204, "One TWO"), (205, prose(rng, 5000)), (206, "é ß  ünïcode \U0001f600 'Ll x's 12"), (7, out[7][1]), (None, out[8][1]), (None, None)]
    out += [(207, "x" * 3000), (208, "<|endoftext|> a<|startoftext|>b\x1cc")]
    rng.shuffle(out)
    return out
