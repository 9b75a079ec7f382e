"""Metadata of papers: the cascade over their text and the validation of disciplines (T-13 to T-21, K-9, K-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X

#: K-9, fixed values: the closed list of first-level disciplines.
LEVEL1 = (
    "数学", "信息科学与系统科学", "力学", "物理学", "化学", "天文学", "地球科学", "生物学", "农学", "林学", "畜牧、兽医科学", "水产学", "基础医学", "临床医学", "预防医学与卫生学", "军事医学与特种医学", "药学",
    "中医学与中药学", "工程与技术科学基础学科", "测绘科学技术", "材料科学", "矿山工程技术", "冶金工程技术", "机械工程", "动力与电气工程", "能源科学技术", "核科学技术", "电子、通信与自动控制技术", "计算机科学技术", "化学工程",
    "纺织科学技术", "食品科学技术", "土木建筑工程", "水利工程", "交通运输工程", "航空、航天科学技术", "环境科学技术", "安全科学技术", "管理学", "经济学", "政治学", "法学", "军事学", "社会学", "民族学",
    "新闻学与传播学", "图书馆、情报与文献学", "教育学", "体育科学", "统计学",
)


def cascade(docs: DataFrame, key: str = "source_key", text: str = "text") -> DataFrame:
    """T-15 to T-20: (key, title, doi, year, abstract, introduction, keywords) read from the text; keywords are null without a section."""
    kw = X.keywords_of(text)
    return docs.select(
        key, X.title(text, X.stem(key)).alias("title"), X.doi_candidate(text).alias("doi"), X.year_candidate(text).alias("year"), X.abstract_candidate(text).alias("abstract"), X.introduction_candidate(text).alias("introduction"), kw.alias("keywords")
    )


def level(d: Column) -> Column:
    """K-9: a discipline with its blanks stripped, lower levels null when blank; null where the first level is not in the list."""
    part = lambda n: F.nullif(X.strip(F.coalesce(d[n], F.lit(""))), F.lit(""))
    return F.when(part("level1").isin(*LEVEL1), F.struct(part("level1").alias("level1"), part("level2").alias("level2"), part("level3").alias("level3")))


def validate_disciplines(meta: DataFrame) -> DataFrame:
    """K-9: metadata with ``primary_valid``, ``secondary_valid`` (each once, none equal to the primary one, null when empty) and
    ``disciplines_ok`` (the first levels of all are in the list)."""
    primary = level(F.col("primary_discipline"))
    each = F.transform(F.coalesce("secondary_disciplines", F.array().cast(meta.schema["secondary_disciplines"].dataType)), level)
    kept = F.array_distinct(F.filter(each, lambda d: d.isNotNull() & ~F.coalesce(d.eqNullSafe(primary), F.lit(False))))
    ok = primary.isNotNull() & ~F.exists(each, lambda d: d.isNull())
    return meta.withColumns({"primary_valid": primary, "secondary_valid": F.when(F.size(kept) > 0, kept), "disciplines_ok": ok})


def assemble(answers: DataFrame, read: DataFrame, key: str = "source_key") -> DataFrame:
    """K-10: model answers (title, year, doi, keywords, disciplines) joined with what the text gives: the answer's title, year and DOI, even when
    null; the paper's own keywords before the answer's; abstract and introduction from the text. A paper without a title is left out."""
    r = read.select(key, "abstract", "introduction", F.col("keywords").alias("own"))
    j = answers.join(r, key).where(X.strip(F.coalesce("title", F.lit(""))) != "")
    return j.withColumn("doi", X.normal_doi("doi")).withColumn("keywords", F.when(F.size("own") > 0, F.col("own")).otherwise(F.coalesce("keywords", F.array().cast("array<string>")))).drop("own")


def current(meta: DataFrame) -> DataFrame:
    """One row a paper: the latest delivery."""
    rest = [n for n in meta.columns if n != "doc_id"]
    return meta.groupBy("doc_id").agg(F.max_by(F.struct(*rest), F.struct(F.coalesce("extraction_info.extraction_timestamp", F.lit("")), F.xxhash64(*rest))).alias("m")).select("doc_id", "m.*")
