"""The scoring rules letter by letter in plain Python: what the lowering is held against."""

from nutq.functions import charclasses as C

MARK_RANGES = ((0x64B, 0x65F), (0x670, 0x670), (0x6D6, 0x6ED), (0x8F0, 0x8FF))
FOLD = dict(zip(C.FOLD_FROM, C.FOLD_TO, strict=True)) | {c: c for c in C.BASE}


def is_mark(c):
    return any(a <= ord(c) <= b for a, b in MARK_RANGES)


def clusters(word):
    """[letter, marks] of the word; what is neither stays out."""
    out = []
    for c in word.replace(C.TATWEEL, ""):
        if c in FOLD:
            out.append([FOLD[c], set()])
        elif is_mark(c) and out:
            out[-1][1].add(c)
    return out


def ratio(text):
    marked = total = 0
    for word in text.split():
        found, open_ = [], False
        for c in word.replace(C.TATWEEL, ""):
            if is_mark(c):
                if open_:
                    found[-1][1] = True
            else:
                open_ = c in FOLD
                if open_:
                    found.append([c, False])
        for raw, has in found[:-1]:
            if raw not in C.VOWEL_CARRIERS:
                total, marked = total + 1, marked + has
    return marked / total if total else 1.0


def key(text):
    return " ".join("".join(x for x, _ in clusters(w)) for w in text.split())


def score(text, word_count, config):
    words = [clusters(w) for w in text.split()]
    letters = [x for w in words for x, _ in w]
    hard_one = lambda x: config.letter_weights.get(x, 0) >= config.hard_threshold
    hard = [x for x in letters if hard_one(x)]
    pairs = [(a[0], b[0]) for w in words for a, b in zip(w, w[1:], strict=False)]
    if config.adjacency_across_words:
        full = [w for w in words if w]
        pairs += [(a[-1][0], b[0][0]) for a, b in zip(full, full[1:], strict=False)]
    kinds = {"emphatic": 0, "same": 0, "hard": 0}
    for a, b in pairs:
        if {a, b} in config.emphatic_pairs:
            kinds["emphatic"] += config.bonus_emphatic_pair != 0
        elif any({a, b} <= members for members in config.articulation_groups.values()):
            kinds["same"] += config.bonus_same_group != 0
        elif hard_one(a) and hard_one(b):
            kinds["hard"] += config.bonus_hard_adjacent != 0
    shadda = madd = idgham = 0
    if config.enable_tajweed:
        for w in words:
            for i, (x, marks) in enumerate(w):
                shadda += C.SHADDA in marks and hard_one(x)
                near = [w[j][0] for j in (i - 1, i + 1) if 0 <= j < len(w)]
                madd += bool(marks & {C.MADDAH, C.DAGGER_ALEF}) and any(map(hard_one, near))
        for a, b in zip(words, words[1:], strict=False):
            if a and b and b[0][0] != "ا":
                tan = lambda k: any("ً" <= m <= "ٍ" for m in a[k][1])  # noqa: B023, E731
                idgham += tan(-1) or (a[-1][0] in "اي" and len(a) > 1 and tan(-2)) or (a[-1][0] == "ن" and C.SUKUN in a[-1][1])
    base = sum((config.letter_weights.get(x, 0) for x in letters))
    near = kinds["emphatic"] * config.bonus_emphatic_pair + kinds["same"] * config.bonus_same_group + kinds["hard"] * config.bonus_hard_adjacent
    marks = shadda * config.bonus_shadda_hard + madd * config.bonus_madd_guttural + idgham * config.bonus_idgham
    raw, size = base + near + marks, len(letters)
    by = size if config.density_basis == "letter" else word_count
    return {
        "letter_count": size, "base_score": base, "hard_letter_count": len(hard), "distinct_hard_letters": ",".join(sorted(set(hard))),
        "adjacency_bonus": near, "hard_adjacent_count": kinds["hard"], "same_group_count": kinds["same"] + kinds["emphatic"], "emphatic_pair_count": kinds["emphatic"],
        "tajweed_bonus": marks, "shadda_hard_count": shadda, "madd_guttural_count": madd, "idgham_count": idgham,
        "raw_score": raw, "density_score": round(raw / by, 6) if by else 0.0, "density_per_letter": round(raw / size, 6) if size else 0.0,
    }
