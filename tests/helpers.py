from histdim.schemas import ACTOR_FILMS, GAME_DETAILS, GAMES, GAME_DETAIL_MEASURES


def films_df(spark, rows):
    """rows: (actorid, actor, year, rating[, filmid]) tuples."""
    out = []
    for i, r in enumerate(rows):
        actorid, actor, year, rating = r[:4]
        fid = r[4] if len(r) > 4 else f"f{i:04d}"
        out.append((actor, actorid, f"Film {fid}", year, 100, rating, fid))
    return spark.createDataFrame(out, ACTOR_FILMS)


def detail(game_id, team_id, player_id, comment=None, min="10:30", pts=1, name="P"):
    vals = {m: 0 for m in GAME_DETAIL_MEASURES}
    vals["pts"] = pts
    return (game_id, team_id, player_id, name, "G", comment, min, *[vals[m] for m in GAME_DETAIL_MEASURES])


def details_df(spark, rows):
    return spark.createDataFrame(rows, GAME_DETAILS)


def games_df(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(g, dt.date.fromisoformat(d), s, h, v) for g, d, s, h, v in rows], GAMES)


def as_dicts(df, order=None):
    rows = df.collect() if order is None else df.orderBy(*order).collect()
    return [r.asDict(recursive=True) for r in rows]
