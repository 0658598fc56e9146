"""Source-repository analytics on Spark: snapshots in, clean tables, features, groups and reports out."""

from .operators.cluster import canonical_ids, kmeans, kmeans_vectors, standardise
from .operators.dedup import first_existing, latest_per_key, top_per_group
from .operators.distinct import distinct_error, distinct_over, distinct_sketches
from .operators.encode import encode_numeric, extend_codes, label_codes, label_encode
from .operators.enrich import KeywordAnnotator, annotate_changed, annotate_replies, enrich, vocabulary_report
from .operators.joins import drill_down, fallback, left_join_suffixed, lookup, present, search
from .operators.profile import by_distinctness, group_means, group_profile
from .operators.ranking import rank_and_share, rank_in_group
from .operators.tallies import (
    crosstab, declared_counts, flow_links, flow_nodes, flow_pairs, hierarchy, histogram, level_counts,
    level_means, level_profile, level_stats, list_counts,
)
from .operators.topk import distinct_options, n_largest, other_bucket, top_counts, top_k_semi, top_values, value_counts
from .plans.clean import (
    clean_commits, clean_contributors, clean_repos, commit_stats, contributor_stats, flag_commits,
    language_details, language_summary, language_totals, row_count, table_stats,
)
from .plans.features import (
    commit_profile, contributor_profile, doc_completeness, ml_ready, readme_features, readme_summary, repo_features,
)
from .plans.weekly import Databases, load_snapshot, run_weekly, setup
from .sources.snapshots import (
    at_snapshot, has_snapshot, latest_snapshot, one_snapshot, read_snapshots, split_corrupt, stack_snapshots, today_utc, write_snapshot,
)
from .sources.tables import append_snapshot, ensure_database, ensure_table, replace_table
from .streaming.ingest import ingest_available, loaded_files, merge_files, snapshot_stream
