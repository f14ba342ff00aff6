import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=1, n=60):
    """Small documents with copies, near copies, shared passages, nulls, empties, short and long texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgäé") for _ in range(r.randint(1, 9))) for _ in range(400)]

    def words(k):
        return " ".join(r.choice(vocabulary) for _ in range(k)).capitalize()

    passage = words(60)
    texts = [None, "", "   \n\t ", "one two", "One  TWO", "x" * 250, "ab" * 300, "word " * 300, passage, passage]
    texts += [words(r.randint(1, 200)) for _ in range(n)]
    base = words(120)
    for _ in range(25):
        w = base.split(" ")
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [words(30) + "\n" + passage + " " + words(20) for _ in range(10)]
    texts += [r.choice(texts[10:40]) for _ in range(10)]
    texts.append(" ".join(words(300) for _ in range(20)))
    texts.append("a\x0bb\x0cc\r\nd e f\na b c # * a b c\n\na b c # * a b c\n é é é")
    order = list(range(len(texts)))
    r.shuffle(order)
    return [(i * 3, texts[k], r.choice(["en", "fr", None]), r.choice(["s0", "s0", "s1", None]), len(texts[k] or "")) for i, k in enumerate(order)]
