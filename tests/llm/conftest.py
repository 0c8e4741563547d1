import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, bits string, component_id string, n_words string, "
    "score string, text_key string, range string, mix_epoch string, n_tokens string, n_entities string, k string, h string, label string"
)
LONG = " ".join(f"w{i % 977}x{i % 1009} {'the of and'.split()[i % 3]}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank"),
    (2, "the quick  brown fox jumps over\nthe LAZY dog near the river bank"),
    (2, "the quick  brown fox jumps over\nthe LAZY dog near the river bank"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "12345 !!! 67890"),
    (None, "A text without an id, of some words"),
    (None, None),
    (7, LONG),
    (8, "one two"),
    (8, "other text under the same id"),
    (9, "écrit à la main, naïve façade çà et là"),
    (10, "The quick brown fox jumps over the lazy dog near the river bank"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, extra columns with clashing names."""
    rows = []
    for i, (doc_id, text) in enumerate(TEXTS):
        source = None if i % 4 == 3 else f"s{i % 2}"
        rows.append((doc_id, text, None if i % 5 == 4 else "en", source, None if text is None else len(text), *["x"] * 12))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
