"""These must stay exactly as they are for results to be comparable."""

# Label set in scoring order (ties go to the earlier label).
LABELS = ("Good", "Standard", "Bad")

# Label ids of the student classifier.
LABEL_IDS = {"Bad": 0, "Standard": 1, "Good": 2}

# Class order of the few-shot exemplars.
FEW_SHOT_ORDER = ("Good", "Bad", "Standard")

# Content-free inputs for the prior. The empty one is asked as one space, and
# the space then counts twice; do not deduplicate.
NULL_FEATURES = ("", "N/A", "None", "Unknown", " ", "---", "###")

# Default student models by flow, and by training method.
DEFAULT_BASE_BY_FLOW = {
    "codegen": "Qwen/Qwen2.5-Coder-3B",
    "idp": "Qwen/Qwen2.5-3B-Instruct",
}
DEFAULT_BASE_OTHER_FLOW = "Qwen/Qwen2.5-3B-Instruct"
DEFAULT_BASE_BY_METHOD = {
    "dpo": "Qwen/Qwen2.5-Coder-3B",
    "kd": "Qwen/Qwen2.5-Coder-3B",
    "sft": "Qwen/Qwen2.5-3B-Instruct",
}

# The characters Python's str.strip() removes.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: label of positions that carry no loss.
IGNORE_INDEX = -100

# Defaults of the length limit, the warm-up share and the seeds.
MAX_LEN = 2048
STUDENT_MAX_LEN = 128
WARMUP_SHARE = 0.03
BALANCE_SEED = 7
SAMPLE_SEED = 42

# Prompt wordings; %s marks where the example goes. Training and scoring differ
# in wording on purpose, and so do the two document prompts.
CREDIT_TRAIN_PROMPT = (
    "Classify the credit risk into one of {Good, Standard, Bad}.\n\n"
    "Features:\n%s\n\nReturn only the label."
)
CREDIT_SCORE_SYSTEM = "You are a careful credit risk classifier."
CREDIT_SCORE_USER = (
    "Classify the credit risk into exactly one of {Good, Standard, Bad}.\n\n"
    "Features:\n%s\n\nReturn only the label."
)
KD_DOCUMENT_PROMPT = (
    "Extract structured fields as strict JSON from the document below.\n\n"
    "<document>\n%s\n</document>\nReturn only JSON."
)
KD_CODE_PROMPT = (
    "You are a helpful coding assistant. Solve the task.\n\n"
    "Problem:\n%s\n\nProduce correct, runnable code."
)
DPO_DOCUMENT_PROMPT = (
    "Extract fields as strict JSON for the following document.\n\n"
    "<document>\n%s\n</document>\nReturn only JSON."
)
DPO_CODE_PROMPT = (
    "You are a helpful coding assistant. Problem:\n%s\nRespond with correct, runnable code."
)
IDP_INFER_PROMPT = (
    "Extract the required fields as strict JSON that matches the schema "
    "from the following document:\n\n%s\n\nReturn only the JSON."
)
CODE_INFER_PROMPT = "You are a coding assistant. Provide correct, runnable code for:\n%s"
CODE_PLAN_INFER_PROMPT = (
    "You are a coding assistant. Solve the task.\n"
    "Please first write a short <PLAN> with bullet steps, then provide the final <CODE>.\n"
    "Problem:\n%s\n"
)
TEACHER_USER_PROMPT = "Customer Data:\n%s"
FEW_SHOT_CASE = (
    "\nCustomer Data:\n%s\nJSON:\n"
    '{"reason": "Brief reasoning about credit risk based on income, debt, utilization, '
    'and payment behaviour.", "label": "%s"}\n'
)
TEACHER_SYSTEM_PROMPT = (
    "\nYou are a highly qualified financial credit risk expert trained to annotate machine "
    "learning training data.\n\n"
    "Your task is to analyze the CUSTOMER DATA below and determine the credit risk category:\n"
    "Bad, Standard, or Good.\n\n"
    "Base your label decision only on the provided financial features.\n"
    "You first reason step by step about the credit risk.\n"
    "Then return your result in the following JSON format:\n\n"
    '{"reason": "...", "label": "..."}\n\n'
    "Examples:\n%s\n"
)

# Turn markers of the default chat template.
CHAT_TURN = "<|im_start|>%s\n%s<|im_end|>\n"
CHAT_ASSISTANT_START = "<|im_start|>assistant\n"

# The invoice schema.
INVOICE_SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "title": "InvoiceExtraction",
    "type": "object",
    "properties": {
        "invoice_number": {"type": "string"},
        "invoice_date": {"type": "string"},
        "vendor_name": {"type": "string"},
        "total_amount": {"type": "number"},
        "currency": {"type": "string"},
        "line_items": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {
                    "description": {"type": "string"},
                    "qty": {"type": "number"},
                    "unit_price": {"type": "number"},
                    "amount": {"type": "number"},
                },
                "required": ["description", "qty", "unit_price", "amount"],
            },
        },
    },
    "required": ["invoice_number", "invoice_date", "vendor_name", "total_amount", "currency"],
}
