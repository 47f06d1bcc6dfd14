"""The column spec every operator is parametrised by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The survey schema the default spec describes.
TIME_ALONE = "Time_spent_Alone"
SOCIAL = "Social_event_attendance"
OUTSIDE = "Going_outside"
FRIENDS = "Friends_circle_size"
POSTS = "Post_frequency"
FEAR = "Stage_fear"
DRAINED = "Drained_after_socializing"

EPS = 1e-8


@dataclass(frozen=True)
class FeatureSpec:
    """Names of the id, the label, the measures and the Yes/No text columns.

    Operators look columns up through the spec and leave out, at plan time,
    whatever a given DataFrame does not have.
    """

    id: str = "id"
    label: str = "Personality"
    positive: str = "Extrovert"
    negative: str = "Introvert"
    alone: str = TIME_ALONE
    social: str = SOCIAL
    outside: str = OUTSIDE
    friends: str = FRIENDS
    posts: str = POSTS
    fear: str = FEAR
    drained: str = DRAINED

    @property
    def measures(self) -> list[str]:
        return [self.alone, self.social, self.outside, self.friends, self.posts]

    @property
    def yes_no(self) -> list[str]:
        return [self.fear, self.drained]

    @property
    def label_code(self) -> str:
        return f"{self.label}_encoded"

    @property
    def not_features(self) -> list[str]:
        return [self.id, self.label, self.label_code]

    def present(self, df: DataFrame, names: list[str]) -> list[str]:
        have = set(df.columns)
        return [name for name in names if name in have]


DEFAULT = FeatureSpec()


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def numeric_columns(df: DataFrame, booleans: bool = False) -> list[str]:
    kinds = (T.NumericType, T.BooleanType) if booleans else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
