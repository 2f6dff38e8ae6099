"""Explicit schemas of the input and canonical tables."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

# Raw dumps; created_utc holds unix seconds as text.
COMMENTS = _struct(
    author=_S, id=_S, body=_S, subreddit=_S, subreddit_id=_S, year=_I, month=_I, created_utc=_S, score=_L
)
SUBMISSIONS = _struct(
    author=_S, id=_S, title=_S, selftext=_S, subreddit=_S, subreddit_id=_S, year=_I, month=_I, created_utc=_S, score=_L
)
# Comments and refined submissions in one table.
ACTIVITY = _struct(
    author=_S, id=_S, body=_S, subreddit=_S, subreddit_id=_S, created_utc=_S, score=_L, year=_I, month=_I
)
SCORED_ACTIVITY = _struct(
    author=_S, id=_S, body=_S, subreddit=_S, subreddit_id=_S, created_utc=_S, score=_L, year=_I, month=_I,
    sentiment=_D, politician_mentioned=_B, shifted=_D,
)
AUTHOR_DATA = _struct(author=_S, shifted=_D, score=_D)
ENGAGEMENT = _struct(political_leaning=_S, score_mean=_D, score_sum=_D, score_max=_D)

# Lexicon tables; `ordinal` fixes which entry wins when several match.
ENTITY_LEXICON = _struct(ordinal=_I, term=_S, grp=_S)
PHRASE_LEXICON = _struct(ordinal=_I, phrase=_S, shift=_D)
SYNONYMS = _struct(phrase=_S, synonym=_S)
VALENCE_LEXICON = _struct(word=_S, valence=_D)
STOPWORDS = _struct(word=_S)
MILESTONES = _struct(name=_S, date=T.DateType())
