"""Deterministic stand-ins for a model. They run inside tasks, hence the local imports."""


def _body(text, status="completed"):
    import json

    payload = {
        "status": status,
        "output": [{"type": "message", "content": [{"type": "output_text", "text": text}]}],
        "usage": {"input_tokens": len(text), "output_tokens": 1},
    }
    return json.dumps(payload, ensure_ascii=False)


def write_samples(request):
    """Two pre-training samples per record; the record's language picks the behaviour."""
    import json

    content = json.loads(request["input"])[0]["content"]
    record = json.loads(content.rpartition("文献 JSON：\n")[2])
    lang = record["文献元数据"]["关键词"][0]
    samples = [{"text": record["文献原文信息"]["摘要"]}, {"text": record["文献元数据"]["标题"]}, {"text": " "}]
    answer = json.dumps(samples, ensure_ascii=False)
    if lang == "de":
        return 500, "busy"
    if lang == "es":
        return 200, _body(answer, "incomplete")
    if lang == "fr":
        return 200, _body("Answer: " + json.dumps({"samples": samples}, ensure_ascii=False))
    return 200, _body("```json\n" + answer + "\n```")


def read_pages(request):
    """A record naming its pages. Without a correction, batches of one page lack a key."""
    import json

    content = json.loads(request["input"])[0]["content"]
    images = [p["image_url"] for p in content if p["type"] == "input_image"]
    texts = [p["text"] for p in content if p["type"] == "input_text"]
    keys = texts[0].split("|")
    record = {k: [] for k in keys}
    record[keys[0]] = {"pages": images}
    if len(images) == 1 and len(texts) == 1:
        del record[keys[-1]]
    if len(images) == 2:
        del record[keys[-1]]
    if len(images) == 3:
        return 200, _body("no JSON here")
    return 200, _body(json.dumps(record, ensure_ascii=False))


def translate_batch(request):
    """Prefixes every text; batches whose first id ends in 3 lose their last record."""
    import json

    content = json.loads(request["input"])[0]["content"]
    items = json.loads(content.rpartition("Source JSON:\n")[2])
    for item in items:
        item["fields"] = {k: "T:" + v for k, v in item["fields"].items()}
    if items[0]["id"] % 10 == 3:
        items = items[:-1]
    return 200, _body(json.dumps(items, ensure_ascii=False))
