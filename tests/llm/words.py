"""Made-up words for small texts."""

WORDS = [f"w{i}x{i * 7 % 13}" for i in range(400)]


def passage(start, count=60):
    return " ".join(WORDS[(start + i) % len(WORDS)] for i in range(count))
