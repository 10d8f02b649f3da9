"""A small league as game documents and odds snapshots, for tests."""

import datetime as dt
import random

TEAMS = ["Harbor", "Summit", "Prairie", "Canyon"]


def stats(draw):
    atbats = draw.randrange(25, 40)
    return {
        "hits": draw.randrange(2, 15), "atbats": atbats, "runs": draw.randrange(0, 10), "strikeouts": draw.randrange(2, 14),
        "baseonballs": draw.randrange(0, 7), "intentionalwalks": draw.randrange(0, 2), "homeruns": draw.randrange(0, 4),
    }


def box(draw, team, played=True):
    def player(i, code, batting, pitching):
        name = f"{TEAMS[team]} {i}"
        return {
            "person": {"id": team * 100 + i, "fullname": name}, "position": {"code": code},
            "stats": {"batting": batting, "pitching": pitching},
        }

    number = stats(draw) if played else {"runs": 0}
    players = {
        f"ID{team}{i}": player(i, "1" if i < 2 else "5", stats(draw) if i != 3 else {}, stats(draw) if i < 3 and played else {})
        for i in range(5)
    }
    return {
        "team": {"id": team, "name": TEAMS[team]}, "teamstats": {"batting": number, "pitching": stats(draw)}, "players": players,
    }


def game(draw, pk, when, home, away, state="Final", number=1, announced=True):
    def club(team):
        wins, losses = draw.randrange(20, 60), draw.randrange(20, 60)
        return {
            "id": team, "name": TEAMS[team], "shortname": TEAMS[team][:3], "league": {"name": "League"},
            "record": {"wins": wins, "losses": losses, "winningpercentage": wins / (wins + losses)},
        }

    def starter(team):
        i = draw.randrange(2)
        return {"id": team * 100 + i, "fullname": f"{TEAMS[team]} {i}"}

    pitchers = {"home": starter(home), "away": starter(away)} if announced else {"home": starter(home), "away": {}}
    return {
        "gamepk": pk,
        "gamedata": {
            "game": {"id": f"{when:%Y/%m/%d}/{TEAMS[away]}-{TEAMS[home]}-{number}", "gamenumber": number, "season": when.year},
            "datetime": {"officialdate": f"{when:%Y-%m-%d}", "daynight": "night", "time": "7:05", "ampm": "PM"},
            "status": {"detailedstate": state},
            "venue": {"name": f"{TEAMS[home]} Park", "location": {"city": TEAMS[home], "state": "ST"}},
            "probablepitchers": pitchers,
            "teams": {"home": club(home), "away": club(away)},
        },
        "livedata": {"boxscore": {"teams": {
            "home": box(draw, home, state == "Final"), "away": box(draw, away, state == "Final"),
        }}},
    }


def season(year, days, seed, first_pk):
    draw = random.Random(seed)
    out, pk = [], first_pk
    for n in range(days):
        when = dt.date(year, 4, 1) + dt.timedelta(days=n)
        home, away = draw.sample(range(4), 2)
        others = [t for t in range(4) if t not in (home, away)]
        for number in (1, 2) if n % 10 == 4 else (1,):
            out.append(game(draw, pk, when, home, away, number=number, announced=n % 7 != 3))
            pk += 1
        out.append(game(draw, pk, when, *others, state="Postponed" if n % 11 == 5 else "Final"))
        pk += 1
    return out


def odds_event(key, home, away, start, books):
    """``books``: list of (bookmaker, last_update, {outcome: price})."""
    return {
        "id": key, "sport_key": "ball", "sport_title": "Ball", "commence_time": start, "home_team": home, "away_team": away,
        "bookmakers": [
            {"key": b, "title": b.title(), "last_update": at, "markets": [
                {"key": "h2h", "last_update": at, "outcomes": [{"name": n, "price": p} for n, p in prices.items()]}
            ] if prices is not None else []}
            for b, at, prices in books
        ],
    }
