"""Declared schemas of landed inputs as DDL, so no reader infers one."""

CLAIMS_REPOSITORY = (
    "`_id` string, text string, content string, link string, createdAt string,"
    " keywords array<string>, media array<string>,"
    " formats array<struct<name:string>>, sources array<struct<name:string>>,"
    " categories array<struct<name:string>>, type struct<name:string>,"
    " organization struct<id:int,name:string>,"
    " organizationCalification struct<calification:struct<id:int,name:string,explanation:string>>"
)

CLAIMS_REVIEW = (
    "`_id` string, text string, claimReview array<struct<publisher:struct<name:string,site:string>,"
    "url:string,title:string,reviewDate:string,textualRating:string,languageCode:string>>"
)

_METRICS = (
    "struct<retweet_count:bigint,reply_count:bigint,like_count:bigint,"
    "quote_count:bigint,impression_count:bigint>"
)

MESSAGES = (
    "fact_id string, tweet struct<id:string,text:string,created_at:string,lang:string,"
    f"author_id:string,conversation_id:string,public_metrics:{_METRICS}>"
)

NEWS_RESPONSE = (
    "fact_id string, total bigint, news array<struct<IdDocument:string,Title:string,Subtitle:string,"
    "Section:string,Date:string,Author:string,Newspaper:string,Page:string,Content:string>>"
)

CLAIM_FEATURES = (
    "fact_id string, url_fact string, date timestamp, calification string,"
    " categories array<struct<name:string>>, claim string, review string,"
    " urls_claim array<string>, urls_review array<string>,"
    " ner_claim map<string,array<string>>, pos_claim map<string,array<string>>,"
    " ner_review map<string,array<string>>, pos_review map<string,array<string>>,"
    " keywords array<string>, keywords_pairs array<array<string>>,"
    " messages_searched_at timestamp, news_searched_at timestamp, news_filtered_at timestamp"
)

PRESS_ARTICLE = (
    "head struct<IdDocument:string,DREDATE:string,Newspaper:string,Title:string,Subtitle:string,"
    "Author:string,Page:string>, body struct<DRECONTENT:string>"
)

WIRE_ITEM = (
    "Identification struct<DateLabel:string,NewsIdentifier:struct<NewsItemId:string>>,"
    " NewsComponent struct<NewsLines:struct<HeadLine:string>,ContentItem:struct<DataContent:string>>"
)

CHANNELS = ("url string, language string")

CHAT_MESSAGES = (
    "id bigint, channelId bigint, date bigint, replyTo struct<replyToMsgId:bigint,replyToTopId:bigint>,"
    " message string, mentioned boolean, post boolean, fromId string, views bigint,"
    " media struct<webpage:struct<cachedPage:struct<url:string,blocks:string>>>"
)

FORUM_COMMENTS = (
    "post_id string, page int, id string, parent_id string, internalId int, isoDate string,"
    " repliesTo array<int>, author string, text string, votes string, karma string,"
    " negative boolean, hiddenByModeration boolean"
)

GOLD = ("`_id` string, text string, accept array<string>")

FLAT_GOLD = (
    "id_tweet string, id_claim string, claim string, `fact-check` string, text string,"
    " label string, label_eng string"
)

PUBLICATIONS = ("nombre string, ref string")
