"""The boundary to outside models: requests in, answers out, in bounded batches on the executors.

Everything else in the engine is expressions; only here Python runs beside Spark. A client is made
once for each partition. Answers should be written to a table keyed by request before they are used,
since tasks may run again.
"""

import base64
import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESPONSE = "request_id string, success boolean, content string, error string, model string, latency_ms int, tokens_used int, cost_usd double, attempts int"
# fixed values: dollars for 1,000 tokens in and out
PRICES = {"gpt-4o": (0.005, 0.015), "gpt-4o-mini": (0.00015, 0.0006)}
DEFAULT_MODEL = "gpt-4o-mini"
# fixed values: the formats of answers
TABLE_SCHEMA = "table_title string, columns array<string>, rows array<map<string,string>>, notes array<string>"
GRAPH_SCHEMA = "diagram_type string, title string, nodes array<struct<id: string, label: string, type: string>>, edges array<struct<`from`: string, `to`: string, label: string, type: string>>, description string"
PINOUT_SCHEMA = "package string, pin_count int, pins array<struct<number: int, name: string, type: string, description: string>>"
CIRCUIT_SCHEMA = "circuit_type string, main_ic string, components array<struct<ref: string, type: string, value: string, connection: string>>, connections array<struct<`from`: string, `to`: string, through: string>>, notes array<string>"
#: What each kind of request asks for, and the schema of its answer.
PROMPTS = {
    "table": ("Read the table of this image. Answer in JSON with table_title, columns, rows (an object a row, with the columns as keys; repeat a merged cell in each cell it covers, leave empty cells empty, keep units in a Unit column) and notes.", TABLE_SCHEMA),
    "block_diagram": ("Read the block diagram of this image. Answer in JSON with diagram_type, title, nodes (id, label, type: block, pin, ground or vcc), edges (from, to, label, type: signal, power or feedback) and description.", GRAPH_SCHEMA),
    "pinout": ("Read the pinout diagram of this image. Answer in JSON with package, pin_count and pins (number, name, type, description).", PINOUT_SCHEMA),
    "application_circuit": ("Read the application circuit of this image. Answer in JSON with circuit_type, main_ic, components (ref, type, value, connection), connections (from, to, through) and notes.", CIRCUIT_SCHEMA),
}


def requests_for(images: DataFrame, kind: str) -> DataFrame:
    """Requests of one kind (a key of PROMPTS) from request_id and image."""
    return images.select(F.col("request_id").cast("string"), F.lit(PROMPTS[kind][0]).alias("prompt"), "image")


def read_answers(answers: DataFrame, kind: str) -> DataFrame:
    """Answers of one kind with `read`, what they say in its schema, null where they failed or are no JSON."""
    return answers.withColumn("read", F.when(F.col("success"), json_answer(F.col("content"), PROMPTS[kind][1])))


Client = Callable[[str, str], dict]


class HttpClient:
    """Posts prompt and image to a chat-completions endpoint. Raises on any failure; `ask_model` turns that into a failed answer."""

    def __init__(self, url: str, key: str, model: str = DEFAULT_MODEL, timeout: float = 60.0, most_tokens: int = 4096):
        self.url, self.key, self.model, self.timeout, self.most_tokens = url, key, model, timeout, most_tokens

    def __call__(self, prompt: str, image: str) -> dict:
        parts = [{"type": "text", "text": prompt}] + ([{"type": "image_url", "image_url": {"url": f"data:image/png;base64,{image}"}}] if image else [])
        body = {"model": self.model, "messages": [{"role": "user", "content": parts}], "max_tokens": self.most_tokens}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with urllib.request.urlopen(request, timeout=self.timeout) as response:
            got = json.load(response)
        used = got.get("usage") or {}
        read, written = used.get("prompt_tokens", 0), used.get("completion_tokens", 0)
        price = PRICES.get(self.model, PRICES[DEFAULT_MODEL])
        return {"content": got["choices"][0]["message"]["content"], "model": self.model, "prompt_tokens": read, "completion_tokens": written, "cost_usd": read / 1000 * price[0] + written / 1000 * price[1]}


class MockClient:
    """Answers by the words of the prompt: a table, a block diagram, else the prompt's first 100 characters."""

    # fixed values
    table = {"table_title": "Electrical Characteristics", "columns": ["Parameter", "Min", "Typ", "Max", "Unit"], "rows": [{"Parameter": "Input Voltage", "Min": "4.5", "Typ": "", "Max": "36", "Unit": "V"}, {"Parameter": "Output Current", "Min": "", "Typ": "3", "Max": "", "Unit": "A"}]}
    graph = {"diagram_type": "block_diagram", "nodes": [{"id": "1", "label": "Input", "type": "pin"}, {"id": "2", "label": "Output", "type": "pin"}], "edges": [{"from": "1", "to": "2", "label": "", "type": "power"}, {"from": "2", "to": "1", "label": "", "type": "feedback"}]}

    def __call__(self, prompt: str, image: str) -> dict:
        low = prompt.lower()
        if "table" in low:
            content = json.dumps(self.table)
        elif "block" in low or "diagram" in low:
            content = json.dumps(self.graph)
        else:
            content = prompt[:100]
        return {"content": content, "model": "mock", "prompt_tokens": 100, "completion_tokens": 50, "cost_usd": 0.0}


def token_cost(model: Column, prompt: Column, completion: Column) -> Column:
    """Dollars of a call; unknown models cost as the small one."""
    table = F.create_map(*[x for m, p in PRICES.items() for x in (F.lit(m), F.array(*map(F.lit, p)))])
    price = F.coalesce(F.try_element_at(table, model), F.array(*map(F.lit, PRICES[DEFAULT_MODEL])))
    return prompt / 1000 * price[0] + completion / 1000 * price[1]


def image_text(content: Column) -> Column:
    return F.base64(content)


def json_answer(content: Column, schema: str) -> Column:
    """The first fenced JSON block of an answer, else the whole answer, parsed; null where it is no JSON."""
    fenced = F.nullif(F.regexp_extract(content, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    text = F.coalesce(fenced, content)
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema))


def within_budget(requests: DataFrame, budget: float, estimate: str = "estimated_cost", order: str = "request_id", waves: str = "wave") -> DataFrame:
    """Adds `sent` and `error`: a request is sent while the costs before it, over all waves in their order, are below the budget; else it fails with the reason.

    Costs are summed by wave, so a window holds one wave, or one row of each wave.
    """
    sums = requests.groupBy(F.col(waves).alias("_wave")).agg(F.sum(estimate).alias("_cost"))
    earlier = Window.orderBy("_wave").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_wave", F.coalesce(F.sum("_cost").over(earlier), F.lit(0)).alias("_earlier"))
    inside = F.coalesce(F.sum(estimate).over(Window.partitionBy(waves).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = requests.withColumn("_inside", inside).join(sums, F.col(waves).eqNullSafe(F.col("_wave")))
    spent = (F.col("_earlier") + F.col("_inside")).cast("double")
    out = joined.withColumn("sent", spent < budget).withColumn("error", F.when(spent >= budget, budget_error(spent, budget)))
    return out.drop("_wave", "_earlier", "_inside")


def budget_error(spent: Column, budget: float) -> Column:
    return F.concat(F.format_string("Budget exceeded: $%.2f >= ", spent), F.lit(f"${budget:.2f}"))


def ask_in_waves(waves: list[DataFrame], make_client: Callable[[], Client], budget: float, keep: Callable[[DataFrame, int], DataFrame], attempts: int = 3, wait: Callable[[int], float] = lambda n: 2.0**n) -> DataFrame:
    """Answers to waves of requests, one after another, until what the answers cost reaches the budget; the requests of later waves fail without a call.

    `keep` writes the answers of a wave and returns the written table: calls are made once, and the
    costs are read from it. With waves of one request the budget stops where a loop over requests would.
    """
    spent, every = 0.0, []
    for n, requests in enumerate(waves):
        if spent < budget:
            answers = keep(ask_model(requests, make_client, attempts, wait), n)
            spent += spend(answers).first()["total_cost"]
        else:
            none = {"success": F.lit(False), "content": F.lit(None).cast("string"), "error": budget_error(F.lit(spent), budget), "model": F.lit(None).cast("string"), "latency_ms": F.lit(0), "tokens_used": F.lit(0), "cost_usd": F.lit(0.0), "attempts": F.lit(0)}
            answers = requests.select(F.col("request_id").cast("string"), *[c.alias(name) for name, c in none.items()])
        every.append(answers)
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out


def ask_model(requests: DataFrame, make_client: Callable[[], Client], attempts: int = 3, wait: Callable[[int], float] = lambda n: 2.0**n) -> DataFrame:
    """One answer for each request (request_id, prompt, image), success false with the last error after `attempts` failures."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                answer, error, began, used = None, None, time.monotonic(), 0
                for n in range(max(attempts, 1)):
                    used = n + 1
                    try:
                        image = base64.b64encode(r.image).decode("ascii") if r.image is not None else ""
                        answer, error = client(r.prompt, image), None
                        break
                    except Exception as e:  # whatever a client raises becomes a failed answer
                        error = f"{type(e).__name__}: {e}"
                        if n + 1 < attempts:
                            time.sleep(wait(n))
                ms = int((time.monotonic() - began) * 1000)
                got = answer or {}
                rows.append((r.request_id, answer is not None, got.get("content"), error, got.get("model"), ms, got.get("prompt_tokens", 0) + got.get("completion_tokens", 0), float(got.get("cost_usd", 0.0)), used))
            yield pd.DataFrame(rows, columns=["request_id", "success", "content", "error", "model", "latency_ms", "tokens_used", "cost_usd", "attempts"])

    return requests.select(F.col("request_id").cast("string"), "prompt", "image").mapInPandas(run, RESPONSE)


def spend(answers: DataFrame) -> DataFrame:
    return answers.where("success").agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("total_cost"))
