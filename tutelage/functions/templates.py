"""Prompt columns. The wordings live in ``constants``; here they only meet the example."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutelage.functions import constants as K
from tutelage.functions.text import _col, supervised_text  # noqa: F401  (re-exported)


def render(template: str, *values: Column | str) -> Column:
    """Put columns in the places marked ``%s``."""
    pieces = template.split("%s")
    parts = [F.lit(pieces[0])]
    for value, after in zip(values, pieces[1:], strict=True):
        parts += [_col(value), F.lit(after)]
    return F.concat(*parts)


def credit_train_prompt(question: Column | str) -> Column:
    return render(K.CREDIT_TRAIN_PROMPT, question)


def credit_messages(features: Column | str) -> Column:
    """System and user turn as ``array<struct<role, content>>``."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", F.lit(K.CREDIT_SCORE_SYSTEM)),
                   turn("user", render(K.CREDIT_SCORE_USER, features)))


def render_chat(messages: Column, turn: str = K.CHAT_TURN, assistant_start: str = K.CHAT_ASSISTANT_START) -> Column:
    """Chat text up to the start of the assistant's answer; the template is a parameter."""
    turns = F.transform(messages, lambda m: render(turn, m["role"], m["content"]))
    return F.concat(F.array_join(turns, ""), F.lit(assistant_start))


def credit_chat_prompt(features: Column | str, turn: str = K.CHAT_TURN,
                       assistant_start: str = K.CHAT_ASSISTANT_START) -> Column:
    return render_chat(credit_messages(features), turn, assistant_start)


def credit_chat_words() -> str:
    """The words that ``credit_chat_prompt`` puts around any features."""
    turns = [(K.CHAT_TURN % ("system", K.CREDIT_SCORE_SYSTEM)), (K.CHAT_TURN % ("user", K.CREDIT_SCORE_USER % " "))]
    return " ".join([*turns, K.CHAT_ASSISTANT_START])


def kd_prompt(text: Column | str, idp_mode: Column | bool = False) -> Column:
    return _by_mode(idp_mode, render(K.KD_DOCUMENT_PROMPT, text), render(K.KD_CODE_PROMPT, text))


def dpo_prompt(text: Column | str, idp_mode: Column | bool = False) -> Column:
    return _by_mode(idp_mode, render(K.DPO_DOCUMENT_PROMPT, text), render(K.DPO_CODE_PROMPT, text))


def sft_prompt(text: Column | str) -> Column:
    return _col(text)


def format_prompt(text: Column | str, training_type: Column | str, idp_mode: Column | bool = False) -> Column:
    """Prompt by method (a column, or a method name) and mode; an unknown method gives ''."""
    method = F.lit(training_type) if isinstance(training_type, str) else training_type
    return (
        F.when(method == "dpo", dpo_prompt(text, idp_mode))
        .when(method == "kd", kd_prompt(text, idp_mode))
        .when(method == "sft", sft_prompt(text))
        .otherwise(F.lit(""))
    )


def served_prompt(text: Column | str, flow: Column) -> Column:
    """Prompt of a served request by flow; other flows send the text as it is."""
    return (
        F.when(flow == "idp", render(K.KD_DOCUMENT_PROMPT, text))
        .when(flow == "codegen", render(K.KD_CODE_PROMPT, text))
        .otherwise(_col(text))
    )


def idp_infer_prompt(document: Column | str) -> Column:
    return render(K.IDP_INFER_PROMPT, document)


def codegen_infer_prompt(problem: Column | str, plan_then_code: Column | bool = False) -> Column:
    return _by_mode(plan_then_code, render(K.CODE_PLAN_INFER_PROMPT, problem), render(K.CODE_INFER_PROMPT, problem))


def teacher_user_prompt(features: Column | str) -> Column:
    return render(K.TEACHER_USER_PROMPT, features)


def few_shot_prompt(exemplars: DataFrame, label_col: str = "answer", text_col: str = "question",
                    order_col: str = "draw", classes: Sequence[str] = K.FEW_SHOT_ORDER) -> DataFrame:
    """One row: the annotation system prompt with its worked cases in class order.

    ``exemplars`` holds k rows per class by construction, so the list gathered here has
    ``k * len(classes)`` entries whatever the size of the pool.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label_col))
    case = render(K.FEW_SHOT_CASE, text_col, label_col)
    cases = F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col(order_col).alias("o"), case.alias("text"))))
    block = F.array_join(F.transform(cases, lambda c: c["text"]), "")
    return exemplars.agg(render(K.TEACHER_SYSTEM_PROMPT, block).alias("system_prompt"))


def _by_mode(mode: Column | bool, yes: Column, no: Column) -> Column:
    if isinstance(mode, bool):
        return yes if mode else no
    return F.when(mode, yes).otherwise(no)
