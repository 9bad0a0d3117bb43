"""Values fixed by the data contract. Nothing here is logic.

Every constant below must hold exactly these values for requests, checks and
output files to be interchangeable with existing data.
"""

# -- fixed values: task catalogue (prompt file stem -> task type) -------------
TASKS = {
    "01_forward_property_prediction": "forward_property_prediction",
    "02_inverse_composition_recommendation": "inverse_composition_recommendation",
    "03_inverse_process_optimization": "inverse_process_optimization",
    "04_inverse_scenario_adaptation": "inverse_scenario_adaptation",
    "05_application_scenario_classification": "application_scenario_classification",
    "06_synthesis_feasibility_prediction": "synthesis_feasibility_prediction",
    "07_anomaly_detection": "anomaly_detection",
    "08_literature_qa": "literature_qa",
    "09_mechanism_explanation": "mechanism_explanation",
}

# -- fixed values: sample fields per method, in output order -------------------
SAMPLE_FIELDS = {
    "CPT": ("text",),
    "SFT": ("task_type", "instruction", "input", "output"),
    "DPO": ("prompt", "chosen", "rejected"),
}

# -- fixed values: sample element format shown to the model --------------------
SAMPLE_FORMATS = {
    "CPT": '[{"text":"..."}]',
    "SFT": '[{"task_type":"%s","instruction":"...","input":"...","output":"..."}]',
    "DPO": '[{"prompt":"...","chosen":"...","rejected":"..."}]',
}

# -- fixed values: wording around a generation request -------------------------
GENERATION_RULES = (
    "硬性要求：\n"
    "1. 只能使用下方文献 JSON 中明确给出的事实，不得杜撰数值、条件或结论。\n"
    "2. 在证据充分且样本不重复的前提下尽可能生成多条数据。\n"
    "3. 每条样本序列化后不得超过 %s 个字符。\n"
    "4. 只返回一个合法 JSON 数组，不要 Markdown 代码块或说明文字。\n"
    "5. 数组元素格式必须为：%s\n\n"
    "文献 JSON：\n"
)

# -- fixed values: top-level keys an extraction record must have, in order -----
RECORD_KEYS = (
    "文献元数据",
    "文献原文信息",
    "基体信息",
    "粉末属性",
    "喷涂工艺参数",
    "微观组织结构",
    "力学性能参数",
    "摩擦学性能",
    "腐蚀性能",
    "涂层组分",
    "热物理性能",
    "耐久性试验",
)

# -- fixed values: correction text of a repeated extraction request ------------
CORRECTION_TEXT = (
    "上一份回答未满足 JSON 结构要求。请重新从提供的页面提取，且只返回一个完整 JSON "
    "对象。根对象必须包含以下全部字段："
    + "、".join(RECORD_KEYS)
    + "。不要把‘文献元数据’中的字段直接放在根对象；没有信息的字段按原要求填 null 或 []。"
)

# -- fixed values: translation ---------------------------------------------------
TRANSLATE_FIELDS = ("instruction", "input", "output", "text", "prompt", "chosen", "rejected")
LANGUAGES = {"zh": "Simplified Chinese", "en": "English"}
TRANSLATION_TEXT = (
    "Translate every string value inside each item's fields object into "
    "%s. Preserve formulas, numbers, units, JSON structure, and meaning. "
    "Do not translate or change id values or field names. Return only a JSON array with "
    "exactly the same shape and item ids; do not add Markdown or explanations.\n\n"
    "Source JSON:\n"
)

# -- fixed values: list members that may wrap an answer, in order of preference --
ENVELOPE_KEYS = ("samples", "data", "items")

# -- fixed values: HTTP answers worth repeating -----------------------------------
RETRYABLE_STATUS = (408, 409, 425, 429)
RETRYABLE_400_TEXT = "disallowed url:"

# -- fixed values: training-set column maps (target column -> source field) --------
DATASET_VIEWS = {
    "cpt": {"prompt": "text"},
    "sft": {"prompt": "instruction", "query": "input", "response": "output"},
}

# -- fixed values: defaults ----------------------------------------------------------
PAGES_PER_REQUEST = 20
IMAGE_MAX_MB = 10.0
MAX_OUTPUT_TOKENS = 524288
SCHEMA_RETRIES = 1
MAX_RETRIES = 2
MAX_SAMPLE_CHARS = 8000
BATCH_RECORDS = 10
BATCH_CHARS = 30000
CALIBRATION_SAMPLES = 64
CALIBRATION_SEED = 42
KEY_PREFIX = "pdf-pages"

# -- fixed values: characters removed by a Unicode-aware strip -----------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# -- fixed values: line ends other than LF and CR(LF) that end a line in a text -------
EXOTIC_LINE_ENDS = "\x0b\x0c\x1c\x1d\x1e\x85  "
