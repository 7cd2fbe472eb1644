"""Column names and schemas of the tables that pass between operators."""

from pyspark.sql import types as T

# File names, column names and types of the input files.
RATINGS_FILE = "ratings.csv"
CATALOG_FILE = "movies.csv"
TAGS_FILE = "tags.csv"
LINKS_FILE = "links.csv"

USER = "userId"
ITEM = "movieId"
RATING = "rating"
TIMESTAMP = "timestamp"
TITLE = "title"
GENRES = "genres"

RATINGS = T.StructType(
    [
        T.StructField(USER, T.IntegerType()),
        T.StructField(ITEM, T.IntegerType()),
        T.StructField(RATING, T.FloatType()),
        T.StructField(TIMESTAMP, T.IntegerType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField(ITEM, T.IntegerType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(GENRES, T.StringType()),
    ]
)

# Factor tables, as MLlib gives them.
ID = "id"
FEATURES = "features"

FACTORS = T.StructType(
    [
        T.StructField(ID, T.IntegerType()),
        T.StructField(FEATURES, T.ArrayType(T.FloatType())),
    ]
)

# Columns that operators add.
PREDICTION = "prediction"
SIMILARITY = "similarity"
LENGTH = "length"
RANK = "rank"
SPLIT = "split"
TRAIN = "train"
TEST = "test"
