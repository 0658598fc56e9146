"""Declared schemas of the raw feeds, the enrichment record and their closed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _BOOL, _TIME, _DOUBLE = (
    T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType(), T.DoubleType()
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The public repository payload, grouped by type. Only a dozen of
# the fields are read downstream; Parquet column pruning makes the rest free.
_REPO_STRINGS = """
    full_name name node_id description language homepage visibility default_branch mirror_url
    html_url url svn_url ssh_url git_url clone_url archive_url assignees_url blobs_url branches_url
    collaborators_url comments_url commits_url compare_url contents_url contributors_url
    deployments_url downloads_url events_url forks_url git_commits_url git_refs_url git_tags_url
    hooks_url issue_comment_url issue_events_url issues_url keys_url labels_url languages_url
    merges_url milestones_url notifications_url pulls_url releases_url stargazers_url statuses_url
    subscribers_url subscription_url tags_url teams_url trees_url
""".split()
_REPO_LONGS = """
    id size stargazers_count watchers_count watchers forks_count forks open_issues_count open_issues
""".split()
_REPO_BOOLS = """
    private fork archived disabled is_template allow_forking web_commit_signoff_required
    has_discussions has_downloads has_issues has_pages has_projects has_wiki
""".split()
_REPO_TIMES = "created_at updated_at pushed_at".split()

REPOS = _struct(
    **{c: _STRING for c in _REPO_STRINGS},
    **{c: _LONG for c in _REPO_LONGS},
    **{c: _BOOL for c in _REPO_BOOLS},
    **{c: _TIME for c in _REPO_TIMES},
    score=_DOUBLE,
    topics=T.ArrayType(_STRING),
    license=_struct(key=_STRING, name=_STRING),
    owner=_struct(login=_STRING, id=_LONG),
    permissions=_struct(admin=_BOOL, push=_BOOL, pull=_BOOL),
)

CONTRIBUTORS = _struct(
    repo_full_name=_STRING, contributor_login=_STRING, contributor_id=_LONG, contributions=_LONG,
    html_url=_STRING, followers_url=_STRING,
)

COMMITS = _struct(
    repo_full_name=_STRING, sha=_STRING, commit_message=_STRING, author_name=_STRING,
    author_email=_STRING, commit_date=_TIME, html_url=_STRING,
)

LANGUAGES = _struct(repo_full_name=_STRING, language=_STRING, bytes=_LONG, extracted_at=_TIME)

README = _struct(
    repo_full_name=_STRING, name=_STRING, path=_STRING, sha=_STRING, size=_LONG, url=_STRING,
    html_url=_STRING, git_url=_STRING, download_url=_STRING, type=_STRING, content=_STRING,
    encoding=_STRING, extracted_at=_TIME,
)

# Feed name -> declared schema; the feed name is also the directory and raw table name.
FEEDS: dict[str, T.StructType] = {
    "github_repos_raw": REPOS,
    "github_contributors_raw": CONTRIBUTORS,
    "github_commits_raw": COMMITS,
    "github_languages_raw": LANGUAGES,
    "github_readme_raw": README,
}

# API payload bodies before flattening.
COMMIT_BODY = T.ArrayType(_struct(
    sha=_STRING, html_url=_STRING,
    commit=_struct(message=_STRING, author=_struct(name=_STRING, email=_STRING, date=_TIME)),
))
CONTRIBUTOR_BODY = T.ArrayType(_struct(
    login=_STRING, id=_LONG, contributions=_LONG, html_url=_STRING, followers_url=_STRING,
))
LANGUAGE_BODY = T.MapType(_STRING, _LONG)
README_BODY = _struct(**{
    f.name: f.dataType for f in README.fields if f.name not in ("repo_full_name", "extracted_at")
})

ENRICHMENT = _struct(
    category=_STRING, tech_stack=T.ArrayType(_STRING), complexity_level=_STRING,
    complexity_score=_LONG, audience=T.ArrayType(_STRING), use_cases=T.ArrayType(_STRING),
)

# Closed vocabularies of the enrichment record.
CATEGORIES = [
    "AI/ML", "DevOps", "System Tools", "Databases", "Web Tools", "System Programming",
    "Graphics", "Embedded", "Networking", "CLI Tools", "Other",
]
COMPLEXITY_LEVELS = ["beginner", "intermediate", "advanced"]
AUDIENCES = [
    "sysadmin", "backend-dev", "frontend-dev", "ML-engineer", "researcher",
    "IT-ops", "security-engineer", "data-engineer", "general-user",
]
USE_CASES = [
    "monitoring", "deployment", "data-processing", "computer-vision", "graphics",
    "caching", "database", "cli-automation", "web-server", "networking", "devops",
]

# Language families behind the has_* flags.
LANGUAGE_FAMILIES: dict[str, list[str]] = {
    "has_web_markup": ["HTML", "CSS"],
    "has_javascript": ["JavaScript", "TypeScript"],
    "has_scripting_language": ["Python", "Ruby", "PHP", "Perl"],
    "has_compiled_language": ["C", "C++", "Java", "C#", "Go", "Rust"],
    "has_shell_scripts": ["Shell", "Batchfile", "PowerShell"],
}

# README spellings, in the order they are tried.
README_NAMES = ["README.md", "Readme.md", "readme.md", "README.MD"]

# Feature sets used for grouping repositories.
OVERVIEW_FEATURES = [
    "stars_count", "forks_count", "total_commits", "total_contributors",
    "repo_age_days", "stars_per_day", "language_count",
]
CLUSTER_FEATURES = OVERVIEW_FEATURES + ["commits_per_contributor", "forks_per_star"]
PROFILE_FEATURES = [
    "stars_count", "forks_count", "total_commits", "total_contributors",
    "stars_per_day", "language_count", "commits_per_contributor",
]

# Display names of the four groups.
CLUSTER_NAMES = {
    0: "Cluster 0: High Activity",
    1: "Cluster 1: Growing Projects",
    2: "Cluster 2: Mature Repos",
    3: "Cluster 3: Niche Projects",
}
