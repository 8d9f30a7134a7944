"""What test modules share; fixtures are in conftest.py."""

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
