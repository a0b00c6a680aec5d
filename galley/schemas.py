"""Relations of the layout corpus as Spark schemas, and the small fixed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Class names in order, their subsets, body and caption pairs, archives, year buckets.
CLASSES = ("figure", "figure_cap", "table", "table_cap", "algorithm", "algorithm_cap", "listing", "listing_cap")
SUBSETS = {"8": CLASSES, "6": CLASSES[:6], "4": CLASSES[:4]}
PAIRS = (("figure", "figure_cap"), ("table", "table_cap"), ("algorithm", "algorithm_cap"), ("listing", "listing_cap"))
ARCHIVES = (
    "astro-ph", "cond-mat", "cs", "econ", "eess", "gr-qc", "hep-ex", "hep-lat", "hep-ph", "hep-th",
    "math", "math-ph", "nlin", "nucl-ex", "nucl-th", "physics", "q-bio", "q-fin", "quant-ph", "stat",
)
YEAR_BUCKETS = ((2023, 2026), (2019, 2022), (2014, 2018), (2007, 2013))
SPLIT_DIRS = {"train": "train", "val": "valid", "test": "test"}
LABEL_RICH = {"table": ("stat", "econ", "q-fin", "q-bio", "eess"), "algorithm": ("cs",)}

_PLAIN = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}


def _parts(text: str) -> list[str]:
    """Split at commas outside angle brackets."""
    out, depth, word = [], 0, ""
    for ch in text:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(word.strip())
            word = ""
        else:
            word += ch
    return [*out, word.strip()]


def _type(text: str) -> T.DataType:
    kind, _, inner = text.partition("<")
    inner = inner[:-1]
    if kind == "array":
        return T.ArrayType(_type(inner))
    if kind == "map":
        return T.MapType(*[_type(x) for x in _parts(inner)])
    if kind == "struct":
        return T.StructType([T.StructField(n, _type(t)) for n, _, t in (x.partition(":") for x in _parts(inner))])
    return _PLAIN[text]


def struct(ddl: str) -> T.StructType:
    """A schema from its text, without a running session."""
    return T.StructType([T.StructField(n, _type(t.strip())) for n, _, t in (x.partition(" ") for x in _parts(ddl))])


PAPER = struct(
    "arxiv_id string, archive string, primary_category string, categories array<string>, year string, title string, "
    "abs_url string, source_url string, status string, reason string, started_at string, finished_at string, "
    "pages_total bigint, pages_with_labels bigint, labels_total bigint, labels_by_kind map<string,bigint>, "
    "box_counts_histogram map<string,bigint>, workspace string, spatial_pair_ok map<string,boolean>"
)
STATE = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("papers", T.MapType(T.StringType(), PAPER)),
    ]
)
MANIFEST = struct("paper_id string, ord int, label_id string, kind string, float_id string, anchor_names array<string>, method string, use_textblock_x boolean")
MANIFEST_DOC = struct("labels array<struct<label_id:string,kind:string,float_id:string,anchor_names:array<string>,method:string,use_textblock_x:boolean>>")
COCO = struct(
    "info struct<paper_id:string,dpi:int,engine:string>, categories array<struct<id:int,name:string>>, "
    "images array<struct<id:int,file_name:string,width:int,height:int>>, "
    "annotations array<struct<id:int,image_id:int,category_id:int,bbox:array<double>,area:double,iscrowd:int,label_id:string>>"
)
GOLDEN = struct("categories array<string>, num_pages int, labels array<struct<label_id:string,kind:string,page:int,bbox:array<int>>>")
CONTROL = struct("skip_primary_cats array<string>, skip_archive_query array<string>, force_next_archive string, note string")
API_ENTRY = struct("arxiv_id string, title string, abs_url string, source_url string, primary_category string, categories array<string>, year string, published string")
CATALOG = struct(
    "arxiv_id string, abs_url string, pdf_url string, source_url string, title string, summary string, authors array<string>, primary_category string, "
    "categories array<string>, published string, updated string, year string, comment string, journal_ref string, doi string, status string, "
    "queried_archive string, also_in_archives array<string>"
)


def subsets_dim(spark: SparkSession) -> DataFrame:
    """(subset, kind, family, is_cap): the classes of each subset; 18 rows."""
    rows = [(s, k, k.removesuffix("_cap"), k.endswith("_cap")) for s, ks in SUBSETS.items() for k in ks]
    return spark.createDataFrame(rows, "subset string, kind string, family string, is_cap boolean")


def subset_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in SUBSETS], "subset string")


def classes_dim(spark: SparkSession, classes: tuple[str, ...] = CLASSES) -> DataFrame:
    """(kind, cls): the output index of each active class."""
    return spark.createDataFrame(list(zip(classes, range(len(classes)), strict=True)), "kind string, cls int")


def archives_dim(spark: SparkSession, archives: tuple[str, ...] = ARCHIVES) -> DataFrame:
    return spark.createDataFrame([(a, i) for i, a in enumerate(archives)], "archive string, ord int")


def year_buckets_dim(spark: SparkSession, buckets: tuple[tuple[int, int], ...] = YEAR_BUCKETS) -> DataFrame:
    return spark.createDataFrame([(lo, hi, i) for i, (lo, hi) in enumerate(buckets)], "lo int, hi int, ord int")
