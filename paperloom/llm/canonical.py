"""Problem 2: mapping free-entered values to a canonical list. SQL only.

Method. A partition-based pigeonhole join: the reference strings are cut into k + 1 segments, of which a value within
k edits must hold one unchanged and at most k places from its own place; segments are joined by equality on positional
substrings, swapped letters by equality of the sorted letters, candidates verified with the built-in ``levenshtein``, and what no entry takes
is reported through an anti join.
Before that, values are brought to plain forms (case, width, quotes, codes, script variants, other-language doubles,
inverted word order), of which any may match; a value that equals an entry in such a form needs no edits at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.tables import materialise

#: Traditional forms and the simplified ones, and signs of similar shape that are typed for each other.
TRADITIONAL = "學數幾論環隨機遊誤計網適應態撲絕緣體電聲傳對稱氫極譜離檢測構質斷層動皺補給氣風邊遺編輯腸經觸覺碼顫脈腫療篩復醫膠塗屬勞紋熱壓識圖強習視標蹤據庫統詢優務處遷顆廢廚餘飛濟資剛價國際貿關稅導樣為過產權專選擇決認訴訟證協課與項問試題驗親讀戲運閾訓練衝擊賽願場館營種節鹽鹼護農藥實軟儀預調訪談間對異療劑構閱維"
SIMPLIFIED = "学数几论环随机游误计网适应态扑绝缘体电声传对称氢极谱离检测构质断层动皱补给气风边遗编辑肠经触觉码颤脉肿疗筛复医胶涂属劳纹热压识图强习视标踪据库统询优务处迁颗废厨余飞济资刚价国际贸关税导样为过产权专选择决认诉讼证协课与项问试题验亲读戏运阈训练冲击赛愿场馆营种节盐碱护农药实软仪预调访谈间对异疗剂构阅维"
LOOKALIKE = "菅側折曰末己入"
MEANT = "管测析日未已人"

#: Words around a value that say nothing about it.
LEAD = r"^(?:the field of|field of|studies in|study of|research on|research in|the|an?)\s+"
TAIL = r"\s*(?:\b(?:research|studies|study|method|methods|field)|[（(]\s*(?:main|new|s|专业)\s*[）)]|相关|方向|领域|研究|专业)\s*$"
CODE = r"^\s*(?:\[\d+\]|\d+[-.]\d+\s*[:：]?|\d+\s*[:：])\s*"


def _plain(x: str) -> str:
    """Lower case, one script, one kind of space."""
    return f"trim(regexp_replace(translate(lower({x}), '{TRADITIONAL}{LOOKALIKE}', '{SIMPLIFIED}{MEANT}'), '(?U)\\\\s+', ' '))"


def _compact(x: str) -> str:
    """Letters and digits only."""
    return f"regexp_replace({x}, '[^\\\\pL\\\\pN]', '')"


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def budget(length: str, text: str) -> str:
    """SQL for the edits allowed: none for short strings and acronyms, two from 8 letters or 4 Chinese signs on."""
    return f"CASE WHEN {text} RLIKE '[\\\\u3400-\\\\u9fff]' THEN CASE WHEN {length} >= 4 THEN 2 WHEN {length} = 3 THEN 1 ELSE 0 END WHEN {length} >= 8 THEN 2 WHEN {length} >= 5 THEN 1 ELSE 0 END"


def map_values(values: DataFrame, refs: DataFrame, head_fields: tuple[str, ...] = ()) -> DataFrame:
    """(field_name, value, ref_id, edits) for each distinct value: the entry that it denotes, or ``NONE``.

    ``values``: field_name, value; ``refs``: ref_id, field_name, canon, canon_alt. ``head_fields`` are the fields whose entries
    may also be the head of a longer wording ("expert interviews") or be shortened word by word ("algo").

    Defined cases: null and empty values give no row; a blank value is ``NONE``; repeated values give one row; of entries at the
    same distance the one that shares most signs, then the least ref_id, is taken; an entry without text is never taken; very long values match only as they stand
    (they exceed every entry by more than the edits allowed); empty tables give an empty result; other columns are ignored.
    """
    spark: SparkSession = values.sparkSession
    heads = ", ".join(f"'{f}'" for f in head_fields) or "''"
    distinct = spark.sql("SELECT DISTINCT field_name, value FROM {v} WHERE value IS NOT NULL AND value <> ''", v=values)

    ref_forms = spark.sql(
        f"""
        SELECT *, {budget("n", "form")} AS k, split(words, '[^\\\\pL\\\\pN]+') AS toks FROM (
          SELECT ref_id, field_name, {_compact("p")} AS form, length({_compact("p")}) AS n, p AS words
          FROM (SELECT ref_id, field_name, {_plain("x")} AS p FROM {{r}} LATERAL VIEW explode(array(canon, canon_alt)) t AS x WHERE x IS NOT NULL)
        ) WHERE n > 0""",
        r=refs.select("ref_id", "field_name", "canon", "canon_alt"),
    )

    # the forms of a value: as it is, without code, its halves, turned round; each with and without filler words
    forms = spark.sql(
        f"""
        WITH plain AS (SELECT field_name, value, regexp_replace({_plain("value")}, '{_sql(CODE)}', '') AS p FROM {{v}}),
        halves AS (
          SELECT field_name, value, explode(array_distinct(concat(
            array(p),
            split(p, '\\\\s*/\\\\s*'),
            split(p, ' - '),
            split(p, '[（(]'),
            CASE WHEN size(split(p, ', ')) = 2 THEN array(concat(element_at(split(p, ', '), 2), ' ', element_at(split(p, ', '), 1))) ELSE array() END
          ))) AS h FROM plain),
        shorn AS (
          SELECT field_name, value, explode(array_distinct(array(h,
            regexp_replace(h, '{_sql(LEAD)}', ''),
            regexp_replace(h, '{_sql(TAIL)}', ''),
            regexp_replace(regexp_replace(regexp_replace(h, '[.。；;]+\\\\s*$', ''), '{_sql(LEAD)}', ''), '{_sql(TAIL)}', '')))) AS h FROM halves)
        SELECT field_name, value, form, length(form) AS n, min(h) AS words
        FROM (SELECT field_name, value, h, {_compact("h")} AS form FROM shorn) WHERE form <> '' GROUP BY field_name, value, form""",
        v=distinct,
    )

    # each is read by several joins below: written once
    ref_forms, forms = materialise(ref_forms, "ref_forms"), materialise(forms, "forms")

    # 1. equal in some form, a plural s aside
    equal = spark.sql(
        """
        SELECT field_name, value, min(ref_id) AS ref_id, 0 AS edits FROM (
          SELECT f.field_name, f.value, r.ref_id FROM {f} f JOIN {r} r ON f.field_name = r.field_name AND f.form = r.form
          UNION ALL
          SELECT f.field_name, f.value, r.ref_id FROM {f} f JOIN {r} r ON f.field_name = r.field_name AND f.form = concat(r.form, 's'))
        GROUP BY field_name, value""",
        f=forms,
        r=ref_forms,
    )
    # 2. the head of a longer wording, or shortened word by word
    headed = spark.sql(
        f"""
        SELECT field_name, value, min(ref_id) AS ref_id, 0 AS edits FROM (
          SELECT f.field_name, f.value, r.ref_id
          FROM (SELECT field_name, value, explode(flatten(transform(sequence(1, size(w)), i -> transform(sequence(i, least(i + 2, size(w))), j -> array_join(slice(w, i, j - i + 1), ''))))) AS run
                FROM (SELECT field_name, value, split(words, '[^\\\\pL\\\\pN]+') AS w FROM {{f}} WHERE field_name IN ({heads})) WHERE size(w) BETWEEN 2 AND 6) f
          JOIN {{r}} r ON f.field_name = r.field_name AND (f.run = r.form OR f.run = concat(r.form, 's'))
          WHERE r.n >= 5
          UNION ALL
          SELECT f.field_name, f.value, r.ref_id
          FROM (SELECT field_name, value, split(words, '[^\\\\pL\\\\pN]+') AS w FROM {{f}} WHERE field_name IN ({heads})) f
          JOIN {{r}} r ON f.field_name = r.field_name AND size(f.w) = size(r.toks) AND substring(f.w[0], 1, 4) = substring(r.toks[0], 1, 4)
          WHERE length(f.w[0]) >= 4 AND forall(zip_with(f.w, r.toks, (a, b) -> length(a) >= 4 AND startswith(b, a)), x -> x))
        GROUP BY field_name, value HAVING count(DISTINCT ref_id) = 1""",
        f=forms,
        r=ref_forms,
    )
    done = spark.sql("SELECT * FROM {e} UNION ALL SELECT h.* FROM {h} h LEFT ANTI JOIN {e} e ON h.field_name = e.field_name AND h.value = e.value", e=equal, h=headed)

    done = materialise(done, "done")

    # 3. within k edits: pigeonhole over segments; swapped letters are two edits, for which the two segments of k = 1 do not suffice, and
    # are joined by their sorted letters
    rest = spark.sql("SELECT f.field_name, f.value, f.form, f.n FROM {f} f LEFT ANTI JOIN {d} d ON f.field_name = d.field_name AND f.value = d.value WHERE f.n >= 3", f=forms, d=done)
    segments = spark.sql(
        """
        SELECT ref_id, field_name, form, n, k, i, start, substring(form, start, size) AS seg FROM (
          SELECT *, CAST(floor(n * i / (k + 1)) AS INT) + 1 AS start, CAST(floor(n * (i + 1) / (k + 1)) - floor(n * i / (k + 1)) AS INT) AS size
          FROM {r} LATERAL VIEW explode(sequence(0, k)) t AS i WHERE k > 0)""",
        r=ref_forms,
    )
    shapes = spark.sql("SELECT DISTINCT field_name, n, k, i, start, length(seg) AS size FROM {s}", s=segments)
    close = spark.sql(
        """
        WITH probes AS (
          SELECT v.field_name, v.value, v.form, s.n, s.k, s.i, substring(v.form, at, s.size) AS seg
          FROM {v} v JOIN {sh} s ON v.field_name = s.field_name AND v.n BETWEEN s.n - 2 AND s.n + 2 AND abs(v.n - s.n) <= greatest(s.k, 1)
          LATERAL VIEW explode(sequence(greatest(1, s.start - s.k), greatest(1, s.start + s.k))) t AS at
          WHERE at + s.size - 1 <= v.n),
        pairs AS (
          SELECT p.field_name, p.value, p.form, r.ref_id, r.form AS ref_form, r.k
          FROM probes p JOIN {s} r ON p.field_name = r.field_name AND p.n = r.n AND p.k = r.k AND p.i = r.i AND p.seg = r.seg
          UNION
          SELECT v.field_name, v.value, v.form, r.ref_id, r.form, r.k
          FROM (SELECT *, array_join(sort_array(split(form, '')), '') AS letters FROM {v} w LEFT SEMI JOIN (SELECT DISTINCT field_name, n FROM {r} WHERE k > 0) l ON w.field_name = l.field_name AND w.n = l.n) v
          JOIN (SELECT *, array_join(sort_array(split(form, '')), '') AS letters FROM {r} WHERE k > 0) r ON v.field_name = r.field_name AND v.letters = r.letters)
        SELECT field_name, value, min_by(ref_id, struct(edits, -shared, ref_id)) AS ref_id, min(edits) AS edits
        FROM (SELECT *, levenshtein(form, ref_form) AS edits, size(array_intersect(split(form, ''), split(ref_form, ''))) AS shared FROM pairs)
        WHERE edits <= k OR (edits = 2 AND length(form) = length(ref_form) AND sort_array(split(form, '')) = sort_array(split(ref_form, '')))
        GROUP BY field_name, value""",
        v=rest,
        sh=shapes,
        s=segments,
        r=ref_forms,
    )
    found = materialise(spark.sql("SELECT * FROM {d} UNION ALL SELECT * FROM {c}", d=done, c=close), "found")
    return spark.sql(
        """
        SELECT field_name, value, ref_id, edits FROM {f}
        UNION ALL
        SELECT v.field_name, v.value, 'NONE', CAST(NULL AS INT) FROM {v} v LEFT ANTI JOIN {f} f ON v.field_name = f.field_name AND v.value = f.value""",
        f=found,
        v=distinct,
    )
