"""Small builders for tests."""

from pyspark.sql import functions as F

from codeweft.sources.files import as_files


def sources(spark, texts, repo="fixture/sample"):
    """Source files from ``{path: text or bytes}``."""
    rows = [(p, t if isinstance(t, bytes) else t.encode()) for p, t in texts.items()]
    return as_files(spark.createDataFrame(rows, "path string, content binary"), F.lit(repo))


ONE_LINE = '__version__ = "1.2"\n'
WITH_FUNCTION = ONE_LINE + '''

def probe(value):
    """A branch."""
    if value > 10:
        return value * 2
    return value
'''
