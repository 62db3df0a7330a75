"""What several test modules need."""


def rows(df, *columns):
    """Rows as sorted tuples, missing values first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
