"""One invented hospital written in all three layouts."""

from __future__ import annotations

import csv
import io
import json

ATTEST = "To the best of its knowledge and belief, this file is complete."
PLANS = [("Alpha Health", "PPO"), ("Beta Care [77]", "Medicare")]
PAYER_FIELDS = {
    "negotiated_dollar": "standard_charge_dollar",
    "negotiated_percentage": "standard_charge_percentage",
    "negotiated_algorithm": "standard_charge_algorithm",
    "methodology": "methodology",
    "median_amount": "median_amount",
    "10th_percentile": "10th_percentile",
    "90th_percentile": "90th_percentile",
    "count": "count",
}

# description, codes, setting, gross, cash, {plan number: payer fields}
ITEMS = [
    ("MRI brain, no contrast", [("611", "RC"), ("70551", "CPT")], "outpatient", "1200", "1080",
     {0: {"negotiated_dollar": "400", "methodology": "fee schedule"},
      1: {"negotiated_dollar": "250.5", "methodology": "case rate"}}),
    ("Hip replacement", [("0470", "MS-DRG")], "inpatient", "", "",
     {0: {"negotiated_dollar": "49000", "methodology": "case rate", "median_amount": "48000",
          "10th_percentile": "1000", "90th_percentile": "50000", "count": "1 through 10"}}),
    ('Dilator 9" x 1"', [("80048", "hcpcs"), ("", "NDC")], "both", "$1,300.25", "270",
     {0: {"negotiated_percentage": "50", "methodology": "percent of total billed charges"},
      1: {"negotiated_algorithm": "120% of Medicare, if lower", "methodology": "other"}}),
    ("Price only", [("99213", "CPT")], "outpatient", "90", "45", {}),
]

META = {
    "hospital_name": "Springfield General", "last_updated_on": "7/1/2026", "version": "3.0.0",
    "location_name": "North | South", "hospital_address": "1 Main St, Springfield", "license_number|ca": "50056",
    "type_2_npi": "0000000001 | 0000000002", ATTEST: "TRUE", "attester_name": "A. Tester",
}


def _csv(rows: list[list[str]]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def _codes(codes: list[tuple[str, str]]) -> list[str]:
    flat = [x for code in codes for x in code]
    return flat + [""] * (4 - len(flat))


_CODE_HEADER = ["code | 1", "code | 1 | type", "code|2", "Code | 2 | type"]


def tall() -> str:
    header = ["Description", *_CODE_HEADER, "setting", "standard_charge | gross", "standard_charge|discounted_cash",
              "payer_name", "plan_name"]
    header += [f"standard_charge | {f}" if "_percentile" not in f and f not in ("median_amount", "count") else f
               for f in PAYER_FIELDS]
    rows = [list(META), list(META.values()), header]
    for description, codes, setting, gross, cash, payers in ITEMS:
        base = [description, *_codes(codes), setting, gross, cash]
        for number, fields in payers.items():
            rows.append([*base, *PLANS[number], *[fields.get(f, "") for f in PAYER_FIELDS]])
        if not payers:
            rows.append([*base, "", "", *[""] * len(PAYER_FIELDS)])
    return _csv(rows)


def wide() -> str:
    header = ["description", *_CODE_HEADER, "setting", "standard_charge|gross", "standard_charge|discounted_cash"]
    for payer, plan in PLANS:
        for f in PAYER_FIELDS:
            plain = "_percentile" in f or f in ("median_amount", "count")
            header.append(f"{f}|{payer}|{plan}" if plain else f"standard_charge | {payer} | {plan} | {f}")
    rows = [list(META), list(META.values()), header]
    for description, codes, setting, gross, cash, payers in ITEMS:
        cells = [payers.get(n, {}).get(f, "") for n in range(len(PLANS)) for f in PAYER_FIELDS]
        rows.append([description, *_codes(codes), setting, gross, cash, *cells])
    return _csv(rows)


def nested() -> str:
    def number(text: str):
        return None if text == "" else text if "$" in text else float(text)

    items = []
    for description, codes, setting, gross, cash, payers in ITEMS:
        charge = {"setting": setting, "gross_charge": number(gross), "discounted_cash": number(cash)}
        charge["payers_information"] = [
            {"payer_name": PLANS[n][0], "plan_name": PLANS[n][1]} | {PAYER_FIELDS[f]: v for f, v in fields.items()}
            for n, fields in payers.items()
        ]
        listed = [{"code": c, "type": t} for c, t in codes]
        items.append({"description": description, "code_information": listed, "standard_charges": [charge]})
    doc = {
        "hospital_name": META["hospital_name"], "last_updated_on": "2026-07-01", "version": "3.0.0",
        "location_name": ["North", "South"], "type_2_npi": "0000000001",
        "license_information": {"license_number": "50056", "state": "CA"},
        "affirmation": {"confirm_affirmation": True, "attester_name": "A. Tester"},
        "standard_charge_information": items, "modifier_information": [{"code": "50", "description": "Bilateral"}],
    }
    return json.dumps(doc, indent=1)


N_PAYER_ROWS = sum(len(i[5]) for i in ITEMS)
