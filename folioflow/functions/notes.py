"""Reader notes on records in Chinese: cleaning, closing, and notes made from what a record holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, blank_to_null, end_sentence, first_sentence, let, replaced_word, squeeze

#: Words that show a note to be an internal message.
TECHNICAL = ("当前模型后端不可用", "规则命中", "论文仍已通过规则筛选", "fallback", "后备路径", "调试", "报错")
#: Openings of a note and what they become, in order; this paper, whether called article or paper.
OPENINGS = (
    (rf"\A仅从题目看[，,:：]?{WS}*", "从题目看，"),
    (rf"\A这篇(?:文章|论文){WS}*(?:确实|很)?值得(?:关注|一读|看|留意)[，,:：]?{WS}*因为(?:它)?", "这篇论文"),
    (rf"\A这篇(?:文章|论文){WS}*(?:确实|很)?值得(?:关注|一读|看|留意)[，,:：]?{WS}*", "这篇论文"),
    (r"\A这篇论文它", "这篇论文"),
    (r"\A这篇论文给出的", "这篇论文给出了"),
    (rf"\A从题目看[，,:：]?{WS}*这篇(?:文章|论文)", "从题目看，这篇论文"),
    (r"\A文章", "这篇论文"),
)
#: Fixed values: "if you care about X, this paper ..." and the tail that names its evidence.
CARE = rf"\A如果你关心(.+?)[，,]{WS}*这篇(?:文章|论文)(.*)\z"
EVIDENCE = "给出的证据"
#: Words of a translation that have an established form.
TERMS = (("LLM", "大语言模型"), ("FinBERT", "FinBERT"))
PHRASES = (("法学硕士", "大语言模型"), ("收益电话会议", "业绩电话会"))
#: Openings of a first sentence that a note does without, and verbs that may follow "this paper".
LEADS = ((r"\A(?:在本文中|在本研究中)[，,]?\s*", ""), (r"\A(?:本文|本研究|本论文)", "这篇论文"), (r"\A作者(?:们)?[，,]?\s*", ""), (r"\A我们[，,]?\s*", ""))
VERBS = "研究 讨论 分析 考察 检验 展示 提出 比较 解释 估计 构建 利用 说明 揭示 发现 关注 刻画 识别 量化 评估 检视 总结 梳理 回顾"


def _evidence(tail: Column) -> Column:
    """What is said of a paper after "this paper": its tail, with evidence given the form of a sentence."""
    kind = F.regexp_replace(tail.substr(F.lit(len(EVIDENCE) + 1), F.length(tail)), r"\A[ ，,。]+|[ ，,。]+\z", "")
    given = let(kind, lambda k: F.when(k == "", "给出了直接证据").otherwise(F.concat(F.lit("给出了"), k, F.lit("的证据"))))
    return F.when(tail == "", "提供了直接证据").when(tail.startswith(EVIDENCE), given).otherwise(tail)


def clean_note(c: Column) -> Column:
    """A note as it may be shown: empty if it is an internal message, openings in their settled form, closed. Null gives null."""
    first, *rest = OPENINGS

    def opened(x: Column) -> Column:
        y = F.regexp_replace(F.replace(x, F.lit("这篇文章"), F.lit("这篇论文")), *first)
        cared = lambda y: F.concat(F.lit("这篇论文围绕"), squeeze(F.regexp_extract(y, CARE, 1)), F.lit("，"), let(squeeze(F.regexp_extract(y, CARE, 2)), _evidence))
        y = let(y, lambda v: F.when(v.rlike(CARE), cared(v)).otherwise(v))
        for pattern, to in rest:
            y = F.regexp_replace(y, pattern, to)
        technical = F.lit(False)
        for word in TECHNICAL:
            technical = technical | F.lower(x).contains(word)
        return F.when(technical, "").otherwise(end_sentence(y))

    return let(squeeze(c), opened)


def settled_terms(c: Column) -> Column:
    """A translation with established terms in place of literal renderings."""
    x = F.trim(c)
    for word, to in TERMS:
        x = replaced_word(x, word, to)
    for phrase, to in PHRASES:
        x = F.replace(x, F.lit(phrase), F.lit(to))
    return x


def missing_summary(title: Column, source: Column, date: Column) -> Column:
    """What stands for the summary of a record without an abstract: the parts that are known."""
    known = F.concat_ws("，", F.concat(F.lit("题目为《"), blank_to_null(title), F.lit("》")), F.concat(F.lit("来源为 "), blank_to_null(source)), F.concat(F.lit("日期为 "), blank_to_null(date)))
    return F.concat(F.lit("未获取到 abstract。该论文"), F.when(known == "", "当前只拿到了题录元数据").otherwise(known), F.lit("。"))


def missing_note(source: Column, date: Column) -> Column:
    """The note of a record without an abstract."""
    return clean_note(F.concat(F.lit("这篇论文目前只拿到了标题与元数据，具体细节还需要查看 "), F.coalesce(blank_to_null(source), F.lit("未知来源")), F.lit(" 在 "), F.coalesce(blank_to_null(date), F.lit("未知日期")), F.lit(" 发布的原文。")))


def note_from(translation: Column, abstract: Column, source: Column, date: Column) -> Column:
    """A note made of a translation's first sentence; without an abstract, the note that says so."""
    edge = r"\A[。；; ]+|[。；; ]+\z"
    x = F.regexp_replace(first_sentence(F.coalesce(translation, F.lit(""))), edge, "")
    for pattern, to in LEADS:
        x = F.regexp_replace(x, pattern, to)
    x = F.regexp_replace(x, edge, "")
    verb = rf"\A(?:{'|'.join(VERBS.split())})"
    bare = F.concat(F.lit("这篇论文发表于 "), F.coalesce(blank_to_null(source), F.lit("未知来源")), F.lit("，日期为 "), F.coalesce(blank_to_null(date), F.lit("未知日期")))
    made = let(x, lambda v: F.when(v == "", bare).when(v.startswith("这篇论文"), v).when(v.rlike(verb), F.concat(F.lit("这篇论文"), v)).otherwise(F.concat(F.lit("这篇论文的重点是"), v)))
    return F.when(F.coalesce(abstract, F.lit("")) == "", missing_note(source, date)).otherwise(clean_note(made))
