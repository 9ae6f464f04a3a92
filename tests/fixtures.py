"""Invented landed pages and lookup lists for end-to-end tests (no copied rows)."""

from __future__ import annotations

import json
import os


def item(i, label, lang="fr"):
    return {"id": str(i), "label": label, "lang": lang}


def a_listing(title, company, published, *, location=None, function=None, job_level=None,
              education=None, experience=None, contract=None, sector=None, work_mode="onsite",
              positions=1, anonymous=False):
    return {
        "title": title, "openPositions": positions, "publishedAt": published,
        "workMode": work_mode, "isAnonymous": anonymous,
        "company": {"name": company, "sector": sector},
        "criteria": {"location": location, "profession": function, "jobLevel": job_level,
                     "educationLevel": education, "experienceYears": experience,
                     "contractType": contract},
    }


def b_listing(title, company, published, *, city="Oran", state="Oran", cardinal="ouest",
              country="Algérie", sector_id=1, function_id=1, exp_id=1, career="cadre",
              study="Bac +2", workplace="en partie depuis la maison", contracts=("CDI",),
              salary=None, applicants=1, views=10, expire=None, positions=1):
    return {
        "title": title, "companyName": company, "nbPosition": positions, "publishedDate": published,
        "expireDate": expire, "nbApplicant": applicants, "nbView": views, "hideCompany": False,
        "nbMonthExperience": None if exp_id is None else str(exp_id),
        "city": None if city is None else {"name": city},
        "region": None if state is None else {"name": state, "cardinal": cardinal},
        "country": None if country is None else {"name": country},
        "sectorGroup": None if sector_id is None else {"id": str(sector_id)},
        "function": None if function_id is None else {"id": str(function_id)},
        "careerLevel": {"name": career}, "studyLevel": {"name": study},
        "workplace": {"name": workplace},
        "contractTypes": None if contracts is None else [{"name": c} for c in contracts],
        "salary": salary,
    }


def write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(obj, f, ensure_ascii=False)


def land_a(base, ds, pages):
    total = sum(len(p) for p in pages)
    for i, rows in enumerate(pages, 1):
        write_json(f"{base}/a/{ds}/pages/page-{i:05d}.json",
                   {"pagination": {"total": total, "totalPages": len(pages)}, "results": rows})


def land_b(base, ds, pages):
    total = sum(len(p) for p in pages)
    for i, rows in enumerate(pages, 1):
        write_json(f"{base}/b/{ds}/pages/page-{i:05d}.json",
                   {"hydra:totalItems": total, "hydra:view": {}, "hydra:member": rows})


def land_lookups(base):
    a = {
        "location": [item(10, "Alger, Alger, Algérie"), item(11, "Centre, Bab Ezzouar, X, Alger, Algérie")],
        "education_level": [item(20, "TS Bac +2"), item(21, "Master")],
        "experience_years": [item(30, "Sans Expérience"), item(31, "3 À 5 Ans")],
        "function": [item(40, "Autre"), item(41, "Informatique")],
        "job_level": [item(50, "Confirmé"), item(51, "Débutant")],
        "sector": [item(60, "Industrie"), item(61, "Banque")],
    }
    for k, v in a.items():
        write_json(f"{base}/a/lookups/{k}.json", {"collection": v})
    write_json(f"{base}/b/lookups/experience.json",
               {"hydra:member": [{"id": "1", "label": "moins de 1 an"}, {"id": "2", "label": "3 à 4 ans"}]})
    write_json(f"{base}/b/lookups/sector.json",
               {"hydra:member": [{"id": "1", "name": "Construction BTP"}, {"id": "2", "name": "Banque / Assurance"}]})
    write_json(f"{base}/b/lookups/function.json",
               {"hydra:member": [{"id": "1", "name": "Juridique / Fiscal"}, {"id": "2", "name": "sport"}]})
