"""Which files count as hand-written."""

import base64
import os
import re

import pytest

from granary.llm import handwritten as H

HAND = "def load(path, limit):\n    rows = []\n    for line in open(path):\n        if len(rows) >= limit:\n            break\n        rows.append(line.strip())\n    return rows\n\n\ndef main():\n    print(load('x', 3))\n    raise SystemExit\n"
MIN = "function a(b,c){if(b){return c}var d=e(b),f=9;for(var g=0;g<b.length;g++)d[g]=b[3]^7;return!function(h){h(d,1)}(c)}" * 8
TABLE = "class A_pb(object):\n" + "".join(f'    _SYM_{i} = _desc(_T{i * 7 % 13}, "name_{i}", {i}, {i % 3})\n' for i in range(60))
BLOB = 'DATA = base64.b64decode("' + base64.b64encode(os.urandom(900)).decode() + '")\n'
NUMBERS = "const int t[] = {\n" + "".join(f"{i * 7919 % 30011}, {i * 104729 % 30011}, {-i * 31 % 997},\n" for i in range(80)) + "};\n"

FILES = {
    "own/src/a.py": ("own", HAND, "handwritten"),
    "own/src/b.py": ("own.git", "# Code generated by x-gen 1.2. DO NOT EDIT.\n" + HAND, "generated"),
    "own/src/c.c": ("OWN/", "/* @generated by x from y.idl */\nint a;\n", "generated"),
    "own/src/d_pb2.py": ("own", HAND, "generated"),
    "own/src/e.py": ("own", TABLE, "generated"),
    "own/src/f.min.js": ("own", "x", "minified"),
    "own/src/g.js": ("own", MIN, "minified"),
    "own/src/h.py": ("own", BLOB, "data"),
    "own/src/i.c": ("own", NUMBERS, "data"),
    "own/src/j.py": ("own", "# Part of other.\n# Copyright (c) 2020 The other Authors\n" + HAND, "vendored"),
    "own/src/k.py": ("own", "# Part of own.\n# Copyright (c) 2020 The own Authors\n" + HAND, "handwritten"),
    "own/ext/other_1z/l.py": ("own", HAND, "vendored"),
    "own/ext/plain_1z/m.py": ("own", HAND, "handwritten"),
    "own/deps/other/x_1/n.py": (None, HAND, "vendored"),
    "other/src/n.py": ("other", HAND, "handwritten"),
    "own/src/o.py": ("own", "# Sorts the pool generated by load_all.\n" + HAND, "handwritten"),
    "own/src/p.py": ("own", "# Edit with care: x is built from this file by hand-run scripts.\n" + HAND, "handwritten"),
    "own/src/q.py": ("own", None, "handwritten"),
    "own/src/r.py": ("own", HAND + "\n# do not edit\n", "handwritten"),
    "own/src/s.js": ("own", "/* zip 1.2.3 - released under a permissive licence, see LICENSE.zip */\nlet a = 1\n", "vendored"),
}


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = [(p, r, c, "e", 1) for p, (r, c, _) in FILES.items()] + [(None, "own", HAND, "", 1), ("own/src/b.py", None, "int x;", "", 2), ("own/src/a.py", "own", HAND, "", 3)]
    df = spark.createDataFrame(rows, "file_path STRING, repo STRING, code STRING, path STRING, chars INT")
    repos = spark.createDataFrame([("own",), ("other",), (None,)], "repo STRING")
    got = H.file_verdicts(df, repos).collect()
    assert len(got) == len(FILES)
    return {r["path"]: r["verdict"] for r in got}


@pytest.mark.parametrize("path", FILES)
def test_verdict(verdicts, path):
    assert verdicts[path] == FILES[path][2]


def test_empty(spark):
    df = spark.createDataFrame([], "file_path STRING, repo STRING, code STRING")
    assert H.file_verdicts(df).count() == 0


def test_counts_equal_python():
    texts = ["", " \n", HAND, MIN, "a\tb é　c 12\n", "x" * 79 + " " + "y" * 81, BLOB, "a b\nc d\na b\nc d\n"]
    m = H.measure(texts)
    for t, row in zip(texts, m.tolist()):
        assert row[0] == len(t) and row[1] == sum(c.isspace() for c in t) and row[2] == sum(c in "0123456789" for c in t)
        assert row[6] == sum(len(x) for x in t.split("\n") if len(x) > H.LONG_LINE)
    assert m[5][3] == 81 and m[7][4] == 4 and m[7][5] == 2


def read(text):
    return H.read_header(H.header(text))


NOTICES = [
    "# Code generated by x-gen 1.2. DO NOT EDIT.\nx = 1", "/* @generated by x from y.idl */", "/* Generated by ANTLR 4.9 */", "-- DO NOT EDIT\nselect 1", '"""Autogenerated. DO NOT EDIT."""\nx = 1', "// Code generated by mockgen. DO NOT EDIT.\npackage x",
    "# Generated by Django 3.2.5 on 2021-08-01 10:00\n", "// Generated from Expr.g4 by ANTLR 4.13.1", "#!/bin/sh\n# This file was automatically generated by configure.\n", "<!-- This page is generated; changes will be lost. -->", "; This file is auto-generated\n", "% This file was generated by a script. Do not edit it.\n",
    "'''\nDo not edit this file by hand.\n'''\n", "/*\n * To regenerate, run make proto\n */", "# -*- coding: utf-8 -*-\n# Generated by the protocol buffer compiler.  DO NOT EDIT!\n", "// <auto-generated>\n//     This code was generated by a tool.\n// </auto-generated>", "(* Generated by Menhir 20230415 - do not edit by hand *)", "{- Automatically generated file -}", "--[[ Generated with luagen ]]",
    "dnl Generated from configure.ac by autoconf\n", "rem Automatically generated by build tools\n", "# GENERATED FILE: see codegen.py\n", "# Machine-generated by exporter 2.\n",
]
NO_NOTICES = [
    "# part of the retry loop\nx", "# Report rows generated from the ledger table\nx", "// do not edit the list while iterating\nx", "# Sorts the pool generated by load_all.", "# Edit with care: x is built from this file by hand-run scripts.", "// changes will be lost if the connection drops", "# Generated ids start at one", "/* automatically generated keys come from the sequence */", "# generated by the caller and passed on",
    "# The page is produced by the view", "# do not modify the buffer while it is in use", "# Never edit a row that another worker holds", "-- rows generated by the trigger", "# Generated by load_all", "// Written by hand, generated never", "# values copied from step 2", "# taken from the request", "// part of speech tags", "/* copyright check for uploads */", "# upstream latency in ms", "# Built from parts that the factory hands over",
    "#include <x.h>\n// do not edit this file\n", "x = 1  # DO NOT EDIT", "int a; /* @generated */", "# this code was reviewed", "# machine-readable output", "# the file is created with mode 0600", "# overwritten by the next call", "# Don't change the order", "/* see license for the terms */", "# the template instead of the value",
]


@pytest.mark.parametrize("text", NOTICES)
def test_notices(text):
    assert read(text)[0]


@pytest.mark.parametrize("text", NO_NOTICES)
def test_no_notices(text):
    notice, sure, _ = read(text)
    assert not notice and not sure


def test_owners():
    sure = lambda t: read(t)[1]
    assert sure("/*! wave v3.3.1 | (c) 2020 | MIT license */") == ["wave"] and sure("/*\n * wave v1.2\n * All rights reserved by the upstream authors.\n */") == ["wave"]
    assert sure("# Vendored from https://github.com/some/wave at abc\n") == ["wave"] and sure("// Upstream: https://wave.example.org/x (1.2)") == ["wave"] and sure("# Copied from wave 1.2.3, changed\n") == ["wave"]
    assert sure("# Part of wave.\n# Copyright (c) 2020 The wave Authors\n") == ["wave"] and read("# Part of wave.\n") == (False, [], ["wave"])


@pytest.mark.parametrize("name", ["Pipfile.lock", "a/Gemfile.lock", "npm-shrinkwrap.json", "uv.lock", "mix.lock", "go.sum", "x/yarn.lock", "package-lock.json"])
def test_lock_files(name):
    assert re.search(H.LOCK_PATH, name) and not re.search(H.LOCK_PATH, name + ".py")


def test_copies_without_a_header(spark):
    body = [HAND + f"\ndef extra_{k}(value):\n    total = value * {k}\n    for step in range(total):\n        value -= step\n    return value\n" for k in range(5)]
    rows = [("lib/src/a.py", "lib", c) for c in body] + [("own/vendor/stuff/a.py", "own", c) for c in body] + [("own/src/copy.py", "own", c) for c in body] + [("own/vendor/few/b.py", "own", body[0]), ("own/vendor/few/b.py", "own", MIN[:300])]
    df = spark.createDataFrame(rows, "file_path STRING, repo STRING, code STRING")
    got = {r["path"]: (r["verdict"], r["evidence"]) for r in H.file_verdicts(df).collect()}
    assert got["own/vendor/stuff/a.py"] == ("vendored", ["copy"])
    assert {got[p][0] for p in ("lib/src/a.py", "own/src/copy.py", "own/vendor/few/b.py")} == {"handwritten"}


def test_headers():
    assert H.header("x = 1\n# not a header") == "" and H.header(None or "") == ""
    assert H.header("  /* a */\n// b\nint x;").strip() == "/* a */\n// b"
    assert H.read_header("/* wave v1.2\n * All rights reserved by the upstream authors. */") == (False, ["wave"], [])
