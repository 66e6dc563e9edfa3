"""Small made-up documents for tests."""

import random

WORDS = "amber birch cedar delta ember fjord grove heron inlet juniper kelp larch maple north otter pine quartz river stone tide".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing", "y7", "é"]) for _ in range(n))


def documents(seed=1, n=60):
    """Texts with exact and near copies, shared lines and passages, repeated rows, null ids and edge cases."""
    rng = random.Random(seed)
    texts = ["\n".join(sentence(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    shared = [sentence(rng, 14) for _ in range(3)]
    passage = sentence(rng, 60)
    rows = []
    for i, t in enumerate(texts):
        if i % 3 == 0:
            t += "\n" + rng.choice(shared) + "\n  " + shared[0].upper() + "\t"
        if i % 7 == 1:
            t = t + " " + passage
        rows.append((i * 10, t))
    for i in range(0, n, 4):  # copies and near copies
        words = rows[i][1].split(" ")
        rows.append((1000 + i, rows[i][1]))
        if len(words) > 60:
            words[rng.randrange(len(words))] = "changed"
        rows.append((2000 + i, " ".join(words)))
    rows += [(3000, None), (3001, ""), (3002, " \n\t\x0b"), (3003, "one"), (3004, "One"), (3005, "one two three four"),
             (3006, "\n" + shared[0] + "\n\n"), (None, texts[3]), (None, None), (None, shared[1])]
    rows += [rows[5], rows[5], (rows[8][0], "another text under an id that is taken " + passage)]
    rows.append((5000, " ".join(["again"] * 3000) + "\n" + "\n".join([shared[2]] * 40) + " " + sentence(rng, 4000)))
    return rows
