"""Small literal relations of our own: principles with hints, refactoring seeds, operations seeds, sources to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.records import record, seed_record

PRINCIPLES = {
    "early return": "check what can go wrong first and leave, so that the main path stays flat",
    "clear names": "let names say what a value means, not how it is stored",
    "single purpose": "let a function do one thing and hand the rest on",
    "explicit errors": "report what failed and with which input instead of hiding it",
    "bounded loops": "give every loop and every buffer an upper bound",
    "no hidden state": "pass what a function needs instead of reading globals",
}
LANGUAGES = ("python", "c", "javascript", "html", "css")

_ALIGNMENT = [
    ("python", "early return", "def load(p):\n    if p:\n        if p.ok:\n            return p.data\n    return None", "Two tests nest around one result; leaving early makes each test stand alone.", "def load(p):\n    if not p or not p.ok:\n        return None\n    return p.data"),
    ("c", "bounded loops", "while (*s) *d++ = *s++;", "Nothing stops the copy at the end of the target.", "for (size_t i = 0; i + 1 < cap && s[i]; i++) d[i] = s[i];\nd[cap - 1] = 0;"),
    ("javascript", "explicit errors", "try { save(x); } catch (e) {}", "The failure disappears, and with it the value that caused it.", "try {\n  save(x);\n} catch (e) {\n  throw new Error(`cannot save ${x.id}`, { cause: e });\n}"),
    ("python", "clear names", "def f(l, x):\n    return [i for i in l if i[2] > x]", "Neither the list nor the bound says what it is; names and an attribute tell it without a comment.", "def overdue(invoices, today):\n    return [invoice for invoice in invoices if invoice.due < today]"),
    ("python", "bounded loops", "while True:\n    r = fetch()\n    if r:\n        break", "A server that never answers keeps this loop busy for ever; a count of attempts ends it.", "for attempt in range(5):\n    reply = fetch()\n    if reply:\n        break\n    time.sleep(2 ** attempt)\nelse:\n    raise TimeoutError('no reply after 5 attempts')"),
    ("python", "no hidden state", "TOTAL = 0\n\ndef add(x):\n    global TOTAL\n    TOTAL += x", "Two callers share one number without knowing of each other; a value that is passed and returned can't be mixed up.", "def add(total, x):\n    return total + x"),
    ("c", "explicit errors", "FILE *f = fopen(p, \"r\");\nfread(buf, 1, n, f);", "A missing file ends in a crash far from its cause; the result is checked where it arises.", "FILE *f = fopen(p, \"r\");\nif (!f) {\n    fprintf(stderr, \"cannot open %s: %s\\n\", p, strerror(errno));\n    return -1;\n}\nsize_t got = fread(buf, 1, n, f);"),
    ("c", "single purpose", "int load_and_sort(const char *p, int *out) {\n    /* reads the file, sorts it and prints it */\n}", "One function reads, orders and prints; each part alone can be tested and used again.", "int load(const char *p, int *out, size_t cap);\nvoid sort(int *values, size_t n);\nvoid print_all(const int *values, size_t n);"),
    ("javascript", "early return", "function price(o) {\n  if (o) {\n    if (o.items.length) {\n      return sum(o.items);\n    }\n  }\n  return 0;\n}", "The one case that matters is two levels deep; leaving early brings it to the front.", "function price(order) {\n  if (!order || order.items.length === 0) return 0;\n  return sum(order.items);\n}"),
    ("html", "clear names", "<div class=\"b2\" onclick=\"go()\">Send</div>", "A div that acts as a button hides what it is from keyboards and readers; the right element says it.", "<button type=\"submit\" class=\"send-order\">Send</button>"),
    ("css", "single purpose", ".x { color: #333; margin: 4px 8px; display: flex; font: 14px/1.4 sans-serif; }", "Type, space and layout change for different reasons; a rule for each can be combined.", ".text { color: #333; font: 14px/1.4 sans-serif; }\n.row { display: flex; }\n.tight { margin: 4px 8px; }"),
]
_OPERATIONS = [
    ("Write a systemd unit that restarts a worker five seconds after it fails.", "[Unit]\nDescription=Worker\n\n[Service]\nExecStart=/usr/local/bin/worker\nRestart=on-failure\nRestartSec=5\n\n[Install]\nWantedBy=multi-user.target"),
    ("Write a Makefile target that removes build products.", ".PHONY: clean\nclean:\n\trm -rf build dist"),
    ("Write a systemd timer that starts a backup every night at half past two.", "[Unit]\nDescription=Nightly backup\n\n[Timer]\nOnCalendar=*-*-* 02:30:00\nPersistent=true\n\n[Install]\nWantedBy=timers.target"),
    ("Write a Dockerfile that builds a Python package in one stage and runs it as an ordinary user in another.", "FROM python:3.12-slim AS build\nWORKDIR /src\nCOPY . .\nRUN pip wheel --no-deps -w /wheels .\n\nFROM python:3.12-slim\nRUN useradd --create-home app\nCOPY --from=build /wheels /wheels\nRUN pip install /wheels/*.whl\nUSER app\nCMD [\"python\", \"-m\", \"app\"]"),
    ("Write a compose file for a web service that waits for a healthy database.", "services:\n  db:\n    image: postgres:16\n    healthcheck:\n      test: [\"CMD\", \"pg_isready\", \"-U\", \"postgres\"]\n      interval: 5s\n  web:\n    build: .\n    depends_on:\n      db:\n        condition: service_healthy"),
    ("Write a Kubernetes Deployment with two replicas and limits on memory.", "apiVersion: apps/v1\nkind: Deployment\nmetadata:\n  name: web\nspec:\n  replicas: 2\n  selector:\n    matchLabels: {app: web}\n  template:\n    metadata:\n      labels: {app: web}\n    spec:\n      containers:\n        - name: web\n          image: web:1\n          resources:\n            limits: {memory: 256Mi}"),
    ("Write a Kubernetes Service that reaches the pods of an app on port 80.", "apiVersion: v1\nkind: Service\nmetadata:\n  name: web\nspec:\n  selector: {app: web}\n  ports:\n    - port: 80\n      targetPort: 8080"),
    ("Write a Kubernetes CronJob that never runs twice at once.", "apiVersion: batch/v1\nkind: CronJob\nmetadata:\n  name: report\nspec:\n  schedule: \"0 4 * * *\"\n  concurrencyPolicy: Forbid\n  jobTemplate:\n    spec:\n      template:\n        spec:\n          restartPolicy: Never\n          containers:\n            - name: report\n              image: report:1"),
    ("Write a logrotate rule that keeps a week of compressed logs.", "/var/log/app/*.log {\n    daily\n    rotate 7\n    compress\n    missingok\n    notifempty\n}"),
    ("Write an nginx server block that passes requests to a local port and sets the client's address.", "server {\n    listen 80;\n    location / {\n        proxy_pass http://127.0.0.1:8080;\n        proxy_set_header X-Real-IP $remote_addr;\n    }\n}"),
    ("Write a shell script that stops at the first error and cleans up its temporary folder.", "#!/usr/bin/env bash\nset -euo pipefail\nwork=$(mktemp -d)\ntrap 'rm -rf \"$work\"' EXIT\ncd \"$work\""),
    ("Write a command that lists the ten largest folders below the current one.", "du -x --max-depth=1 . | sort -rn | head -n 10"),
    ("Write a Terraform block for a storage bucket that keeps old versions.", "resource \"aws_s3_bucket\" \"data\" {\n  bucket = \"example-data\"\n}\n\nresource \"aws_s3_bucket_versioning\" \"data\" {\n  bucket = aws_s3_bucket.data.id\n  versioning_configuration { status = \"Enabled\" }\n}"),
    ("Write an Ansible task that installs a package and restarts its service only if it changed.", "- name: Install the proxy\n  apt:\n    name: haproxy\n    state: present\n  notify: restart proxy\n\nhandlers:\n  - name: restart proxy\n    service:\n      name: haproxy\n      state: restarted"),
    ("Write a Prometheus alert for a service that hasn't answered for five minutes.", "groups:\n  - name: web\n    rules:\n      - alert: WebDown\n        expr: up{job=\"web\"} == 0\n        for: 5m\n        labels: {severity: page}"),
    ("Write a GitHub Actions workflow that runs the tests on every push.", "on: [push]\njobs:\n  test:\n    runs-on: ubuntu-latest\n    steps:\n      - uses: actions/checkout@v4\n      - run: python -m pip install -e .[test]\n      - run: python -m pytest -q"),
    ("Write a Makefile that rebuilds an object file when a header changes.", "CFLAGS += -MMD -MP\nobjects := $(patsubst %.c,%.o,$(wildcard *.c))\n\napp: $(objects)\n\t$(CC) -o $@ $^\n\n-include $(objects:.o=.d)"),
    ("Write an ssh client configuration that reaches an inner host through a gateway.", "Host gateway\n    HostName gateway.example.org\n    User ops\n\nHost inner\n    HostName 10.0.0.5\n    ProxyJump gateway"),
    ("Write an iptables rule set that drops all incoming traffic but ssh and replies.", "iptables -P INPUT DROP\niptables -A INPUT -i lo -j ACCEPT\niptables -A INPUT -m conntrack --ctstate ESTABLISHED,RELATED -j ACCEPT\niptables -A INPUT -p tcp --dport 22 -j ACCEPT"),
    ("Write a cron entry that runs a script at six on weekdays and keeps its output.", "0 6 * * 1-5 /usr/local/bin/report.sh >> /var/log/report.log 2>&1"),
]
_PAPERS = [("Why should a data pipeline write its intermediate tables?", "A written table lets a failed run start again from the last finished step, and it can be inspected apart from the code that made it."),
    ("Why are near-duplicate texts removed before a model is trained?", "A text that comes many times weighs as many times in training, is learned by heart, and may stand in the test set too; one copy of each keeps both the training and its measure honest."),
]
#: Repositories to clone, and reference pages to fetch: name, address and what they are.
_REPOSITORIES = [
    ("requests", "https://github.com/psf/requests", "python", "Apache-2.0"), ("click", "https://github.com/pallets/click", "python", "BSD-3-Clause"), ("attrs", "https://github.com/python-attrs/attrs", "python", "MIT"), ("zlib", "https://github.com/madler/zlib", "c", "Zlib"),
    ("jq", "https://github.com/jqlang/jq", "c", "MIT"), ("express", "https://github.com/expressjs/express", "javascript", "MIT"), ("html5-boilerplate", "https://github.com/h5bp/html5-boilerplate", "html", "MIT"), ("normalize.css", "https://github.com/necolas/normalize.css", "css", "MIT"),
    ("kubernetes-examples", "https://github.com/kubernetes/examples", "devops", "Apache-2.0"),
]
_PAGES = {
    "python": ("https://docs.python.org/3/library/{}.html", ("json", "re", "csv", "pathlib", "logging", "sqlite3", "heapq", "bisect", "contextlib", "dataclasses", "itertools", "functools")),
    "c": ("https://en.cppreference.com/w/c/{}", ("string/byte/strlen", "string/byte/strncpy", "string/byte/memchr", "io/fopen", "io/fgets", "io/snprintf", "memory/calloc", "memory/realloc", "algorithm/qsort", "algorithm/bsearch")),
    "web": ("https://developer.mozilla.org/en-US/docs/Web/{}", ("HTML/Element/button", "HTML/Element/dialog", "HTML/Element/template", "CSS/gap", "CSS/grid-template-areas", "CSS/position", "API/fetch", "API/URL", "JavaScript/Reference/Global_Objects/Map", "JavaScript/Reference/Statements/for...of")),
}


def alignment_seeds(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(_ALIGNMENT, "language STRING, principle STRING, bad STRING, thought STRING, good STRING")
    return rows.select(*seed_record(*map(F.col, ("language", "principle", "bad", "thought", "good"))))


def operations_seeds(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(_OPERATIONS, "i STRING, o STRING")
    return rows.select(*record(F.col("i"), F.col("o"), layer="devops", language="devops", source="seed"))


def paper_rows(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(_PAPERS, "i STRING, o STRING")
    return rows.select(*record(F.col("i"), F.col("o"), layer="alignment", source="whitepaper"))


def principle_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PRINCIPLES.items()), "principle STRING, hint STRING")


def repositories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_REPOSITORIES, "repo STRING, url STRING, language STRING, license STRING")


def reference_pages(spark: SparkSession) -> DataFrame:
    """Addresses of reference pages: family, key (as the page's reader wants it), url."""
    return spark.createDataFrame([(f, k, form.format(k)) for f, (form, keys) in _PAGES.items() for k in keys], "family STRING, key STRING, url STRING")
