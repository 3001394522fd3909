"""The parts that can be plugged in, by kind; `register` adds to them."""

from .config import Registry
from .operators import batch, model, params, rules, verify
from .sources import files

COMPARATORS = Registry("comparator", verify.COMPARATORS)
ARBITERS = Registry("arbiter", verify.ARBITERS)
VERIFIERS = Registry("verification", {"double": verify.verifier, "quick": verify.quick_verify})
SOURCES = Registry("ingestion", {"folder": files.list_files, "pages": files.read_pages})
ENGINES = Registry("engine", {"rule": rules.extract_page_tables, "model": model.ask_model})
FORMATTERS = Registry("formatter", {"json": files.write_json, "documents": files.write_documents, "csv": files.write_csv, "importer": params.importer_rows, "wide": params.wide_rows, "review": params.review_records, "report": batch.batch_report})
CLIENTS = Registry("client", {"mock": model.MockClient, "http": model.HttpClient})
KINDS = {r.kind: r for r in (COMPARATORS, ARBITERS, VERIFIERS, SOURCES, ENGINES, FORMATTERS, CLIENTS)}
