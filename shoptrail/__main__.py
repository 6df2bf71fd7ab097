"""The four jobs from the command line, for ``spark-submit`` or ``python -m shoptrail``."""

from __future__ import annotations

import argparse

from shoptrail import constants as c
from shoptrail.plans import jobs
from shoptrail.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shoptrail", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, text: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        for path in paths:
            sub.add_argument(path)
        return sub

    command("features", "clean a raw log, compute user features", "input", "output")
    pairs = command("pairs", "inverted index and frequent item pairs", "log", "output")
    pairs.add_argument("--top", type=int, default=c.TOP_ITEM_PAIRS)
    clusters = command("clusters", "cluster users by their features", "features", "output")
    clusters.add_argument("--k", type=int, default=c.KMEANS_K)
    clusters.add_argument("--max-iter", type=int, default=c.KMEANS_MAX_ITER)
    clusters.add_argument("--tol", type=float, default=c.KMEANS_TOL)
    clusters.add_argument("--seed", type=int, default=c.KMEANS_SEED)
    recommend = command("recommend", "items for one user", "log", "target", "output")
    recommend.add_argument("--alpha", type=float, default=c.WALK_ALPHA)
    recommend.add_argument("--max-iter", type=int, default=c.WALK_MAX_ITER)
    recommend.add_argument("--tol", type=float, default=c.WALK_TOL)
    recommend.add_argument("--top", type=int, default=c.TOP_RECOMMENDATIONS)
    for sub in (pairs, clusters, recommend):
        sub.add_argument("--form", choices=("text", "parquet"), default="text")
    return parser


def main(arguments: list[str] | None = None) -> None:
    a = _parser().parse_args(arguments)
    spark = build_session(f"shoptrail-{a.job}")
    if a.job == "features":
        counts = jobs.clean_and_features(spark, a.input, a.output)
        print(f"{counts['kept']} of {counts['lines']} lines are valid records")
    elif a.job == "pairs":
        jobs.index_and_co_occurrence(spark, a.log, a.output, a.form, a.top)
    elif a.job == "clusters":
        jobs.cluster_users(
            spark, a.features, a.output, a.k, a.max_iter, a.tol, a.seed, a.form
        )
    else:
        jobs.recommend(
            spark, a.log, a.target, a.output, a.alpha, a.max_iter, a.tol, a.top, a.form
        )


if __name__ == "__main__":
    main()
